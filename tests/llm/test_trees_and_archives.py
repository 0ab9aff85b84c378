"""The conversation trie, the Merkle manifest and the WARC archives against plain Python."""

import base64
import gzip
import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from .conftest import prose


# --- conversation trie ------------------------------------------------------------------------------

def _trie(rows):
    own = defaultdict(list)
    for r in rows:
        if r[0] is not None:
            role, text = r[2] or "", r[3] or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[r[0]].append(((r[1] is not None, r[1] or 0), digest, role, text))
    turns = {c: [x[2:] for x in sorted(own[c])] for c in own}
    paths = {}
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - c % 5 if c >= 0 else c + (-c) % 5
        paths[c] = tuple(turns.get(base, [])[:h] + mine[h:])
    members = defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    saved, leaves = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
            leaves[p[:d]] += children[p] == 0
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if paths[c] == p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


SCHEMA = "conv_id long, turn long, role string, text string, depth int, a string, k long, n double"


def _conversations():
    r = random.Random(5)
    rows = []
    for c in range(-7, 150):
        for t in range(r.choice([1, 2, 3, 5, 9, 14])):
            rows.append((c, t, r.choice(["user", "assistant"]) if t > 2 else "user", "hello" if t < 2 else f"text {r.randrange(2)}"))
    rows += [(500, t, "user", "same " * t) for t in range(70)] + [(505, t, "user", "same " * t) for t in range(70)]
    rows += [(c, t, "user", f"copy {t}") for c in range(600, 900) for t in range(5)]
    rows += [(1000, None, None, None), (1000, 0, "user", ""), (1000, 0, "user", ""), (1001, None, "é", "ü" * 50), (1002, 3, None, "x"), (None, 1, "user", "nobody")]
    return rows


@pytest.mark.parametrize("block, ids", [(4, 4096), (1, 4096), (3, 7)])
def test_trie(spark, block, ids):
    from transfero.llm.op11_conversation_trie import trie
    rows = _conversations()
    frame = spark.createDataFrame([(*r, 1, "x", 2, 0.5) for r in rows], SCHEMA)
    assert sorted([tuple(r) for r in trie(frame, block, ids).collect()], key=str) == _trie(rows)


def test_trie_of_nothing(spark):
    from transfero.llm.op11_conversation_trie import trie
    assert trie(spark.createDataFrame([], SCHEMA)).collect() == []
    assert trie(spark.createDataFrame([(None, 1, "u", "t", 1, "x", 2, 0.5)], SCHEMA)).collect() == []


# --- manifest ---------------------------------------------------------------------------------------

def _manifest(rows, change, fanout):
    """rows: (doc_id, source, lang, n_chars, text)."""
    h = lambda *x: hashlib.sha256("".join(x).encode()).hexdigest()
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r: h(*map(field, r))

    def proofs(nodes):
        """Siblings (left, right) of every node, level by level, and the root."""
        steps = [[] for _ in nodes]
        at = list(range(len(nodes)))
        while len(nodes) > 1:
            for i, p in enumerate(at):
                lo = p // fanout * fanout
                steps[i].append(("".join(nodes[lo:p]), "".join(nodes[p + 1:lo + fanout])))
            nodes = [h(*nodes[i:i + fanout]) for i in range(0, len(nodes), fanout)]
            at = [p // fanout for p in at]
        return steps, nodes[0]

    by_lang = defaultdict(list)
    for r in rows:
        by_lang[r[2]].append(r)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for x in langs:
        by_lang[x].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[x] = proofs([leaf(r) for r in by_lang[x]])
    tops, root = proofs([trees[x][1] for x in langs])
    out = []
    for n, x in enumerate(langs):
        for r, steps in zip(by_lang[x], trees[x][0]):
            steps, folded = steps + tops[n], leaf((*r[:4], change(r)))
            for left, right in steps:
                folded = h(left, folded, right)
            out.append((r[0], leaf(r), trees[x][1], root, h(*(a + b for a, b in steps)), folded, folded == root))
    return sorted(out, key=str)


def _changed(r):
    text = r[4]
    if text is None or r[0] is None or zlib.crc32(str(r[0]).encode()) % 3:
        return text
    return text.translate({c: c + 32 for c in range(65, 91)})


DOCS = "doc_id long, source string, lang string, n_chars long, text string, p long, total string, i int"


@pytest.mark.parametrize("fanout, levels, n", [(8, 4, 700), (2, 1, 217), (3, 1, 100), (8, 1, 600), (2, 2, 1)])
def test_manifest(spark, fanout, levels, n):
    from pyspark.sql import functions as F
    from transfero.llm.op12_merkle_manifest import LOWER, UPPER, manifest
    rows = [(i, ["s", None][i % 2], ["en", "de", None, "", "es"][min(i % 23, 4)] if i % 3 else "en", i, ["Ünder A", "", None, prose(i, 5)][i % 4]) for i in range(n)]
    rows += [rows[0], rows[0], (None, None, None, None, None), (None, None, None, None, None), (3, "s", "en", 4, "other B"), (9000, "s", "only", 1, "Z" * 100_000)]
    frame = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], DOCS)
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    got = manifest(frame, F.when(hit, F.translate("text", UPPER, LOWER)), fanout, levels).drop("lang").collect()
    assert sorted([tuple(r) for r in got], key=str) == _manifest(rows, _changed, fanout)


def test_manifest_of_nothing(spark):
    from transfero.llm.op12_merkle_manifest import manifest
    assert manifest(spark.createDataFrame([], DOCS)).collect() == []


# --- archives ---------------------------------------------------------------------------------------

PAGES = "page_id long, url string, html string, key string, size int, last string"


def _pages():
    rows = [(i, f"https://M{i % 5}.Example.org/p/{i % 60}?q={i % 2}#x", prose(i % 90, 30) if i % 4 else "copied page") for i in range(400)]
    return rows + [(1000, None, None), (1001, "", ""), (None, "no scheme/x y", "copied page"), (None, None, "alone"), rows[3], rows[396], rows[396],
                   (2000, "http://a:80/\r\n", "a\r\n\r\nb" * 50_000), (2001, "http://u@h.é/", "Ünïcode ☃")]


@pytest.mark.parametrize("lines, least", [(1000, 0), (7, 0), (3, 20)])
def test_archives(spark, tmp_path, lines, least):
    from pyspark.sql import functions as F
    from transfero.llm.op13_warc import build_index, lookup, read_archives, url_key, write_archives
    rows = _pages()
    frame = spark.createDataFrame([(*r, "k", 1, "l") for r in rows], PAGES)
    folder = f"file://{tmp_path}/warc"
    fences = build_index(write_archives(frame, folder, least), folder, lines)
    found = lookup(frame.select(url_key(F.col("url")).alias("key"), "page_id"), folder, fences)
    got = read_archives(found, folder, bodies=True).collect()
    groups = defaultdict(list)
    for page, _, html in rows:
        groups[(html or "").encode()].append(page)
    assert len(got) == len(rows)
    seen = defaultdict(list)
    for r in got:
        payload = r.html.encode()
        assert r.payload_bytes == len(payload) and r.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        seen[payload].append(r)
    assert set(seen) == set(groups)
    for payload, pages in groups.items():
        assert sorted(r.page_id or -1 for r in seen[payload]) == sorted(p or -1 for p in pages)
        responses = [r.page_id for r in seen[payload] if r.record_type == "response"]
        last = max(pages, key=lambda p: -1 if p is None else p)
        if len(payload) < least:
            assert len(responses) == len(pages)
        else:
            assert responses == [last]
        assert all(r.refers_to == last for r in seen[payload] if r.record_type == "revisit")
    # plain WARC readers see one gzip member a record
    records = b"".join(gzip.decompress(f.read_bytes()) for f in (tmp_path / "warc").glob("*.warc.gz"))
    assert records.count(b"WARC/1.1\r\nWARC-Type: ") == len(rows)

    one = lookup(spark.createDataFrame([("org,example,m0)/p/0?q=0", 0), ("org,example,m0)/p/0?q=0", -5), ("zz", 1), ("-", None), ("", 0)], "key string, page_id long"), folder, fences)
    assert sorted(-1 if r.page_id is None else r.page_id for r in one.collect()) == [-1, 0]


def test_archives_of_nothing(spark, tmp_path):
    from transfero.llm.op13_warc import build_index, lookup, read_archives, write_archives
    frame, folder = spark.createDataFrame([], PAGES), f"file://{tmp_path}/none"
    fences = build_index(write_archives(frame, folder), folder)
    assert fences == [] and read_archives(lookup(frame.select("key", "page_id"), folder, fences), folder).collect() == []


def test_url_key(spark):
    from pyspark.sql import functions as F
    from transfero.llm.op13_warc import url_key
    urls = {"https://m.Example.org:80/a?b#c": "org,example,m:80)/a?b", "http://user@h.net": "net,h)", "x/y": "x)/y", None: "-", "": ")"}
    got = spark.createDataFrame([(u,) for u in urls], "url string").select("url", url_key(F.col("url")).alias("k")).collect()
    assert {r.url: r.k for r in got} == urls
