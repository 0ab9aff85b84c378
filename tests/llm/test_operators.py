"""Each operator against brute force on edge cases, and defined results for empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from .conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(t):
    return WORD.findall(t or "")


def key(row):
    return tuple((x is None, x) for x in row)


def same(got, want):
    assert sorted(map(key, got)) == sorted(map(key, want))


def test_substring_dedup(edge_docs, no_docs):
    from transfero.llm.op01_substring_dedup import substring_dedup
    rows = [(r.doc_id, words(r.text)) for r in edge_docs.collect()]
    seen = Counter(tuple(w[i:i + 35]) for _, w in rows for i in range(len(w) - 34))
    want = []
    for d, w in rows:
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - 34):
            if seen[tuple(w[i:i + 35])] > 1:
                gone[i:i + 35] = True
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        want.append((d, len(w), int(gone.sum()), hashlib.sha256(kept.encode()).hexdigest()))
    same([tuple(r) for r in substring_dedup(edge_docs).collect()], want)
    assert substring_dedup(no_docs).collect() == []


def test_hot_anchor_is_cut_into_windows(spark, monkeypatch):
    from transfero.llm import op01_substring_dedup as op
    monkeypatch.setattr(op, "HOT", 5)
    shared, pair = prose(50, 8), prose(51, 40)
    docs = [(i, prose(100 + i, 30) + " " + shared + " " + prose(200 + i, 30)) for i in range(20)]
    docs += [(90, shared + " " + pair), (91, prose(60, 5) + " " + shared + " " + pair)]
    got = {r.doc_id: r.n_removed for r in op.substring_dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {**{i: 0 for i in range(20)}, 90: 48, 91: 48}


def test_common_passage_does_not_fill_one_group(spark, monkeypatch):
    from pyspark.sql import functions as F
    from transfero.llm import op01_substring_dedup as op
    monkeypatch.setattr(op, "HOT", 10)
    dealt, matched = [], op.matched

    def watched(items):
        dealt.append(items.groupBy("key" if "key" in items.columns else "anchor").count().agg(F.max("count")).first()[0] or 0)
        return matched(items)

    monkeypatch.setattr(op, "matched", watched)
    passage = prose(40, 60)
    docs = [(i, f"{prose(1000 + i, 40)} own{i} {passage} its{i} {prose(2000 + i, 40)}") for i in range(60)]
    docs += [(100, f"{prose(41, 20)} lone {' '.join(passage.split()[:36])} end"), (101, f"{prose(42, 20)} short {' '.join(passage.split()[:34])} end"), (102, docs[0][1])]
    got = {r.doc_id: r.n_removed for r in op.substring_dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    whole = len(words(docs[0][1]))
    assert got == {**{i: 60 for i in range(1, 60)}, 100: 36, 101: 0, 0: whole, 102: whole}
    assert dealt[0] <= 10


def test_fm_index_matches_counting():
    from transfero.llm.fm_index import FMIndex
    r = np.random.default_rng(1)
    texts = [r.integers(0, 3, r.integers(4, 40)) for _ in range(60)]
    weights = r.integers(1, 3, len(texts))
    flat, starts = np.concatenate(texts), np.cumsum([0, *map(len, texts)])[:-1]
    index = FMIndex(flat, starts, weights)
    count = Counter()
    for t, w in zip(texts, weights):
        for i in range(len(t) - 5):
            count[tuple(t[i:i + 6])] += int(w)
    got = index.repeated(flat, starts, np.array(list(map(len, texts))), 6)
    for t, m in zip(texts, got.tolist()):
        assert m == sum(1 << i for i in range(len(t) - 5) if count[tuple(t[i:i + 6])] >= 2)


def test_neighbours(spark):
    from pyspark.sql import functions as F
    from transfero.llm.op02_neighbours import search
    r = np.random.default_rng(2)
    x = r.standard_normal((4000, 16)) + 3 * r.standard_normal((12, 16))[r.integers(0, 12, 4000)]
    x[100:400] = x[100]  # a frequent vector: ties go to the smaller id
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    rows += [(5000, None, 1), (5020, [], 1), (5040, [0.0] * 16, 1), (5060, [float("nan")] * 16, 1), (5080, [None] + [1.0] * 15, 1), (5100, [1.0] * 3, 1), (None, [1.0] * 16, 1), rows[20]]
    rows += [rows[41]] * 30  # an id that comes often counts once
    got = defaultdict(dict)
    for row in search(spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int"), F.col("vec_id") % 20 == 0).collect():
        got[row.query_id][row.rank] = (row.vec_id, row.score)
    assert set(got) == set(range(0, 4000, 20))
    hit = 0
    for q, found in got.items():
        s = x @ x[q]
        s[q] = -np.inf
        true = np.lexsort((np.arange(4000), -s))[:20]
        assert list(found) and sorted(found) == list(range(1, 21))
        assert all(abs(s[v] - score) < 1e-9 for v, score in found.values())
        hit += len(set(true.tolist()) & {v for v, _ in found.values()})
    assert hit / (20 * len(got)) >= 0.9
    few = search(spark.createDataFrame(rows[:5], "vec_id long, embedding array<double>, score int"), F.col("vec_id") % 20 == 0).collect()
    assert len(few) == 4
    assert search(spark.createDataFrame([], "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0).collect() == []


def test_neighbours_by_the_registered_query(spark, tmp_path, monkeypatch):
    """The registered query learns parts and searches fewer than half of them on clustered vectors."""
    from transfero.llm import op02_neighbours as op
    r = np.random.default_rng(4)
    x = r.standard_normal((4000, 16)) + 6 * r.standard_normal((12, 16))[r.integers(0, 12, 4000)]
    spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    learned, learn = [], op.learn
    monkeypatch.setattr(op, "learn", lambda *a, **k: learned.append(learn(*a, **k)) or learned[-1])
    got = defaultdict(set)
    for row in op.op2_neighbours(spark, str(tmp_path)).collect():
        got[row.query_id].add(row.vec_id)
    _, parts, probes = learned[0]
    assert parts == 8 and 2 * probes < parts
    s = x[::20] @ x.T
    s[np.arange(200), np.arange(0, 4000, 20)] = -np.inf
    hit = sum(len(got[20 * q] & set(np.argsort(-s[q])[:20].tolist())) for q in range(200))
    assert hit >= 0.9 * 20 * 200


def targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return {**target, **share}
        for s in over:
            target[s] = 3 * sizes[s]
            left -= target[s]
        free -= over
    return target


def test_mixing(spark, edge_docs, no_docs):
    from transfero.llm.op03_mixing import mix, mixture
    many = spark.createDataFrame([(i, prose(i, 1 + i % 90), f"s{i % 7 if i % 3 else 0}") for i in range(1500)], "doc_id long, text string, source string")
    for docs in (edge_docs, many):
        rows = docs.collect()
        sizes = defaultdict(int)
        for r in rows:
            sizes[r.source] += len(words(r.text))
        want = targets(sizes)
        got = mix(docs).collect()
        assert Counter((r.doc_id, r.size) for r in got) == Counter((r.doc_id, len(words(r.text))) for r in rows)
        taken = defaultdict(int)
        for r in got:
            assert 0 <= r.taken <= 3 * r.size and r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
            taken[r.source] += r.taken
        assert all(abs(taken[s] - want[s]) <= 4 for s in want)
        again = mix(docs).collect()
        assert sorted(key((r.doc_id, r.taken)) for r in got) == sorted(key((r.doc_id, r.taken)) for r in again)
        out = mixture(docs)
        assert out.columns == docs.columns
        # every row comes whole, as often as its words are taken, rounded
        n, m = Counter((r.doc_id, r.text) for r in out.collect()), Counter()
        texts = Counter((r.doc_id, r.text) for r in rows)
        times = {(r.doc_id, r.size): int(r.taken / r.size + 0.5) for r in got if r.size}
        for (doc_id, t), k in texts.items():
            m[doc_id, t] += k * times.get((doc_id, len(words(t))), 0)
        assert n == +m and any("\n" in t for _, t in n if docs is edge_docs) == (docs is edge_docs)
    assert mix(no_docs).collect() == [] and mixture(no_docs).collect() == []


def test_quality(spark, edge_docs, no_docs):
    from transfero.llm.op04_quality import quality
    got = defaultdict(list)
    for r in quality(edge_docs).collect():
        got[r.doc_id].append(r)
    rows = edge_docs.collect()
    assert sum(map(len, got.values())) == len(rows)
    for row in rows:
        w, t = words(row.text), row.text or ""
        n = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
        mark = np.zeros(len(w), bool)
        for i in range(len(w) - 7):
            if n[tuple(w[i:i + 8])] > 1:
                mark[i:i + 8] = True
        lines = [x for x in t.split("\n") if WORD.search(x)]
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), int(mark.sum()))
        failed = len(w) < 20 or 100 * int(mark.sum()) > 30 * len(w)
        assert any((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want and r.base_failed == failed and not (failed and r.kept) for r in got[row.doc_id])
    assert quality(no_docs).collect() == []
    good = [(i, prose(i, 200), "en") for i in range(60)]
    bad = [(100, " ".join(f"%{w}|#" for w in prose(70, 200).split()), "en"), (101, prose(71, 200).upper(), "en"), (102, "zq xw " + " ".join(f"vk{i}" for i in range(200)), "en")]
    kept = {r.doc_id: r.kept for r in quality(spark.createDataFrame(good + bad, "doc_id long, text string, lang string")).collect()}
    assert all(kept[i] for i in range(60)) and not any(kept[i] for i in (100, 101, 102))
    # junk is no reference, neither for its own language nor for texts without one
    junk = [(200, bad[0][1], "xx"), (201, bad[0][1], None), (202, prose(72, 200), "yy"), (203, prose(73, 200), None)]
    kept = {r.doc_id: r.kept for r in quality(spark.createDataFrame(good + junk, "doc_id long, text string, lang string")).collect()}
    assert all(kept[i] for i in [*range(60), 202, 203]) and not any(kept[i] for i in (200, 201))


def test_quality_distances(spark):
    """Both distances against the formulas in plain Python."""
    import math
    import re
    from transfero.llm import op04_quality as op
    docs = [(i, prose(i, 60 + i), "en" if i % 2 else "de") for i in range(60)] + [(90, prose(5, 100).upper() + " 123 45, (x) — ¿", "en")]
    got = {r.doc_id: r for r in op.quality(spark.createDataFrame(docs, "doc_id long, text string, lang string"), min_reference=1).collect()}

    def classes(text):
        import unicodedata
        out = [0] * 6
        for c in text:
            kind = unicodedata.category(c)
            out[0 if kind == "Ll" else 1 if kind == "Lu" else 2 if kind[0] == "L" else 3 if kind[0] == "N" else 4 if c in ".,;:!?'\"()-" else 5] += not c.isspace()
        return [*out, len(text) - sum(out)]

    def js(p, q):
        half = lambda a, b: sum(0.5 * x * math.log2(2 * x / (x + y)) for x, y in zip(a, b) if x > 0)
        return math.sqrt(max(0.0, half(p, q) + half(q, p)))

    for lang in ("en", "de"):
        texts = [t for _, t, x in docs if x == lang]
        sums = [sum(x) for x in zip(*map(classes, texts))]
        reference = [x / sum(sums) for x in sums]
        counts = Counter(w.lower() for t in texts for w in t.split(" ") if len(w) <= 4 and re.fullmatch(r"[^\W\d_]+", w))
        top = [w for w, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:40]]
        total = sum(len(t.split(" ")) for t in texts)
        shares = [counts[w] / total for w in top]
        for doc_id, text, x in docs:
            if x == lang:
                own, length, n = classes(text), len(text), len(text.split(" "))
                p = [sum(w.lower() == r for w in text.split(" ") if len(w) <= 4) / n for r in top]
                assert abs(got[doc_id].char_distance - js([c / length for c in own], reference)) < 1e-6
                assert abs(got[doc_id].word_distance - js([*p, 1 - sum(p)], [*shares, 1 - sum(shares)])) < 1e-6


def test_quality_without_a_language(spark, monkeypatch):
    from transfero.llm import op04_quality as op
    r = random.Random(5)
    vocabulary = {x: ["".join(r.choice(letters) for _ in range(r.randrange(2, 5))) for _ in range(30)]
                  for x, letters in {"aa": "abcde", "bb": "fghij", "cc": "klmno", "dd": "pqrst", "ee": "uvwxyz"}.items()}
    text = lambda x: " ".join(r.choice(vocabulary[x]) for _ in range(200))
    docs = [(i, text(x), x) for i, x in enumerate(sorted(vocabulary) * 20)]
    docs += [(1000 + i, text(x), None) for i, x in enumerate(sorted(vocabulary))]
    docs += [(2000, text("aa").upper(), None), (2001, " ".join(f"%{w}|#" for w in text("bb").split()), None), (2002, None, "ff"), (2003, "", "zz")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    rows = {r.doc_id: r for r in op.quality(frame).collect()}
    assert len(rows) == len(docs) and all(rows[i].kept for i in [*range(100), *range(1000, 1005)])
    assert not any(rows[i].kept for i in (2000, 2001, 2002, 2003))
    monkeypatch.setattr(op, "MAX_LANGS", 2)
    assert {r.doc_id: r for r in op.quality(frame).collect()} == rows
    none = op.quality(frame.filter("doc_id < 5").selectExpr("doc_id", "text", "cast(null as string) lang")).collect()
    assert len(none) == 5 and all(r.kept != r.base_failed and r.word_distance is None for r in none)


def library():
    import public_tokenizers as P
    from tokenizers import Tokenizer
    return Tokenizer.from_file(P.path("byte_bpe_50k.json"))


def test_packing_and_counts(edge_docs, no_docs):
    from transfero.llm.op05_packing import pack
    from transfero.llm.op06_token_counts import token_counts
    rows, t = edge_docs.collect(), library()
    ids = [t.encode(r.text or "", add_special_tokens=False).ids for r in rows]
    same([tuple(r) for r in token_counts(edge_docs).collect()], [(r.doc_id, len((r.text or "").encode()), len(i), len(i) > 512) for r, i in zip(rows, ids)])
    pieces = pack(edge_docs).collect()
    by_sequence = defaultdict(list)
    for p in pieces:
        by_sequence[p.sequence_id].append(p)
    fill = []
    for s in by_sequence.values():
        s.sort(key=lambda p: p.offset)
        assert [p.offset for p in s] == [sum(q.length for q in s[:i]) for i in range(len(s))]
        fill.append(sum(p.length for p in s))
        assert 0 < fill[-1] <= 2048
    assert sum(fill) == sum(len(i) + 1 for i in ids)
    padding = sum(0 if f & (f - 1) == 0 else 2048 - f for f in fill)
    assert padding <= 0.02 * sum(fill)
    whole = {r.doc_id: np.array(i + [1], "<u4") for r, i in zip(rows, ids) if r.doc_id is not None}
    for p in pieces:
        if p.doc_id is not None:
            part = whole[p.doc_id][p.start:p.start + p.length]
            assert p.doc_tokens == len(whole[p.doc_id]) and p.ids_crc32 == zlib.crc32(part.tobytes()) and len(part) == p.length
    cover = Counter()
    for p in pieces:
        cover[p.doc_id] += p.length
    assert cover[5] == len(whole[5]) and cover[6] == 3 * len(whole[6])
    assert pack(no_docs).collect() == [] and token_counts(no_docs).collect() == []


def test_least_squares_beats_greedy_start():
    from transfero.llm.op05_packing import combinations, solve
    lengths = np.array([300, 512, 700, 1024, 1036, 1348])
    columns = combinations(lengths, 2048)
    assert len(columns) and all(sum(lengths[i] for i in c if i >= 0) == 2048 for c in columns)
    x = solve(columns, np.array([4.0, 0, 6, 10, 0, 6]))
    fit = np.zeros(6)
    for c, v in zip(columns, x):
        for i in c:
            if i >= 0:
                fit[i] += v
    assert (x >= 0).all() and abs(fit[5] - 6) < 1 and abs(fit[3] - 10) < 1


def test_similarity_join(spark, edge_docs, no_docs):
    from transfero.llm.op07_similarity_join import one_of_each, similarity_join
    r = random.Random(3)
    near = []
    for g in range(6):
        base = prose(300 + g, 150).split()
        for k in range(30):
            w = list(base)
            for _ in range(r.randrange(4)):
                w[r.randrange(len(w))] = f"x{r.randrange(99)}"
            near.append((1000 + 100 * g + k, " ".join(w)))
    for docs in (edge_docs, spark.createDataFrame(near, "doc_id long, text string")):
        rows = [(x.doc_id, x.text, words(x.text)) for x in docs.collect()]
        sets = [frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset() for _, _, w in rows]
        up = list(range(len(rows)))

        def top(i):
            while up[i] != i:
                i = up[i]
            return i

        links = [0] * len(rows)
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                if a and b and len(a & b) >= 0.8 * len(a | b) - 1e-9:
                    links[i] += 1
                    links[j] += 1
                    up[top(i)] = top(j)
        least = {}
        for i, (d, _, _) in enumerate(rows):
            if d is not None:
                least[top(i)] = min(d, least.get(top(i), d))
        want = [(d, least.get(top(i)), links[i]) for i, (d, _, _) in enumerate(rows)]
        got = [(x.doc_id, x.class_id, x.n_links) for x in similarity_join(docs).collect()]
        same(got, want)
        kept = one_of_each(docs)
        assert kept.columns == docs.columns
        ids = Counter(x.doc_id for x in kept.collect())
        assert {d for d in ids if d is not None} == {d for d, c, _ in want if d is not None and (c == d)}
        assert all(n == 1 for d, n in ids.items() if d is not None)
    assert similarity_join(no_docs).collect() == [] and one_of_each(no_docs).collect() == []


def test_one_of_each_class_stays(spark):
    from transfero.llm.op07_similarity_join import one_of_each
    near = lambda base, k: " ".join(base.split()[:149] + [f"x{k}"])
    a, b, c = prose(500, 150), prose(501, 150), prose(502, 150)
    rows = [(None, near(a, 1), "a"), (None, near(a, 2), "a"), (None, near(a, 2), "a"), (7, near(b, 1), "b"), (7, near(b, 2), "b"), (None, near(b, 3), "b"),
            (7, near(c, 1), "c"), (9, near(c, 2), "c"), (7, near(c, 1), "c"), (None, None, "none"), (None, "", "none"), (None, prose(503, 90), "d")]
    kept = one_of_each(spark.createDataFrame(rows, "doc_id long, text string, class string")).collect()
    assert Counter(r["class"] for r in kept) == {"a": 1, "b": 1, "c": 1, "d": 1, "none": 2}
    assert {r["class"]: r.doc_id for r in kept if r["class"] in "bc"} == {"b": 7, "c": 7}


def test_large_groups_are_verified_in_blocks(spark, monkeypatch):
    from transfero.llm import op07_similarity_join as op
    monkeypatch.setattr(op, "HOT", 10)
    monkeypatch.setattr(op, "BLOCK", 8)
    base = prose(400, 300).split()
    docs = [(i, " ".join(base[:i] + [f"new{i}"] + base[i + 1:])) for i in range(40)]
    got = op.similarity_join(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert all((r.class_id, r.n_links) == (0, 39) for r in got)


def test_secrets(spark, edge_docs, no_docs):
    from transfero.llm.op08_secrets import joined, pattern_spans, redact, secrets, train
    r = random.Random(4)
    rand = lambda n: "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    texts = [f"{prose(i, 30)} get_user_name_from_request password = {rand(24)} end" for i in range(80)]
    texts += [f"é{prose(1, 3)} API-KEY token=password=abcdefghijklmnop Token: 'short' x", "token=secret:ABCDEFGHIJKLMNOP", "AKIA1234567890ABCD AKIA12 deadbeefdeadbeef00 0123456789abcde",
              "api_key: \"" + "a" * 12 + "\" PASSWD=" + "b" * 11, f"here {rand(32)} there", "a_long_ordinary_identifier_name here", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assign = re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")

    def want(t):
        t = t or ""
        s = [(m.start(), 0, m.end(), "assign") for m in assign.finditer(t) if len(m[2]) >= 12]
        s += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
        s += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 16]
        return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(s))

    found = {x.doc_id: (x.b, x.a) for x in secrets(docs, train(docs)).select("doc_id", joined(__import__("pyspark.sql.functions", fromlist=["col"]).col("_base")).alias("b"), joined(__import__("pyspark.sql.functions", fromlist=["col"]).col("_all")).alias("a")).collect()}
    for i, t in enumerate(texts):
        assert found[i][0] == want(t), t
    at = {t: i for i, t in enumerate(texts) if t}
    random_token = next(i for t, i in at.items() if t.startswith("here "))
    assert "markov:5:37" in found[random_token][1]
    assert found[at["a_long_ordinary_identifier_name here"]][1] == ""
    clean = {x.doc_id: x.text for x in redact(docs).collect()}
    assert clean[random_token] == "here [SECRET] there" and clean[0].endswith("end") and "password" not in clean[0]
    assert redact(edge_docs).columns == edge_docs.columns and redact(edge_docs).count() == edge_docs.count()
    assert redact(no_docs).collect() == []


def test_markov_spans(spark):
    """Every Markov span, and the redacted text, against plain Python; texts with more spans than a fold's part."""
    from pyspark.sql import functions as F
    from transfero.llm.op08_secrets import THRESHOLD, redact, secrets
    r = random.Random(9)
    model = [round(r.uniform(-3, 4), 4) for _ in range(16384)]
    token = lambda n, letters: "".join(r.choice(letters) for _ in range(n))
    base62 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
    texts = ["", "x", " ".join(token(r.randrange(10, 40), r.choice([base62, "0123456789abcdef"])) for _ in range(900))]
    texts += [" ".join(r.choice([f"password={token(30, base62)}", token(40, "0123456789abcdef"), "AKIA" + token(20, "ABC123"), f"é{token(24, base62)}", "plain words"])
                       for _ in range(400)) for _ in range(3)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {x.doc_id: ([tuple(s) for s in x.base], [tuple(s) for s in x.all]) for x in secrets(docs, model).select(
        "doc_id", F.col("_base").alias("base"), F.col("_all").alias("all")).collect()}
    clean = {x.doc_id: x.text for x in redact(docs, model=model).collect()}
    added = 0
    for i, t in enumerate(texts):
        base, everything = rows[i]
        want = list(base)
        for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", t):
            c = [min(ord(x), 127) for x in m[0]]
            mean = sum(model[x * 128 + y] for x, y in zip(c, c[1:])) / (len(c) - 1)
            if abs(mean - THRESHOLD) < 1e-6:
                continue
            if mean > THRESHOLD and not any(a < m.end() and m.start() < b for a, _, b in base):
                want.append((m.start(), 3, m.end()))
        assert everything == sorted(want)
        added += len(want) - len(base)
        out, at = [], 0
        for a, _, b in everything:
            if a >= at:
                out += [t[at:a], "[SECRET]"]
            at = max(at, b)
        assert clean[i] == "".join(out) + t[at:]
    assert added > 100 and max(len(x) for _, x in rows.values()) > 400


def test_secrets_of_long_texts_take_time_in_proportion(spark):
    import time
    from transfero.llm.op08_secrets import redact
    r = random.Random(10)
    text = lambda n: " ".join("".join(r.choice("0123456789abcdef") for _ in range(17)) for _ in range(n))
    model = [0.0] * 16384

    def took(n):
        docs = spark.createDataFrame([(1, text(n))], "doc_id long, text string")
        start = time.time()
        (out,) = redact(docs, model=model).collect()
        assert out.text == " ".join(["[SECRET]"] * n)
        return time.time() - start

    took(2000)
    small, large = min(took(8000) for _ in range(2)), min(took(32000) for _ in range(2))
    assert large < 8 * small + 1


def test_toxicity(spark, edge_docs, no_docs):
    from transfero.llm.op09_toxicity import fit, toxicity
    r = random.Random(5)
    docs, labels = [], []
    for i in range(1500):
        bad = r.random() < 0.2
        w = prose(i, 60).split()
        if bad:
            for _ in range(4):
                w.insert(r.randrange(len(w)), r.choice(["idiotish", "you", "scumlike", "idiotic"]))
        docs.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    labels += [(None, 1), (3, None), (9999, 1), labels[0]]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = fit(d, lab)
    score = {x.doc_id: x.score for x in toxicity(d, model).collect()}
    held = [(i, y) for i, y in labels[:1500] if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((score[i] >= 0.5) == bool(y) for i, y in held) >= 0.95 * len(held)
    assert all(0 <= x.score <= 1 for x in toxicity(edge_docs, model).collect())
    assert toxicity(edge_docs, model).count() == edge_docs.count()
    none = fit(no_docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {x.score for x in toxicity(edge_docs, none).collect()} == {0.0} and toxicity(no_docs, model).collect() == []


def test_every_language_is_learned(spark):
    from transfero.llm.op10_language import fit, identify
    r = random.Random(8)
    docs, n = [], 300
    for lang in range(n):  # a frequent one and 299 rare ones, each with syllables of its own
        parts = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(4)) for _ in range(6)]
        for k in range(900 if lang == 7 else 6):
            docs.append((len(docs), " ".join(r.choice(parts) for _ in range(120)), f"l{lang:03}"))
    docs += [docs[-1]] * 50
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    langs, matrix = fit(d)
    seen = {lang for i, _, lang in docs if zlib.crc32(str(i).encode()) % 5}
    assert langs == sorted(seen) and len(seen) >= 295 and matrix.shape[1] == len(seen)
    got = {x.doc_id: x.lang_pred for x in identify(d.select("doc_id", "text"), (langs, matrix)).collect()}
    held = [(i, lang) for i, _, lang in docs if zlib.crc32(str(i).encode()) % 5 == 0 and lang in seen]
    assert sum(got[i] == lang for i, lang in held) >= 0.97 * len(held)


def test_language(spark, edge_docs, no_docs):
    from transfero.llm.op10_language import fit, identify, known_language
    r = random.Random(6)
    parts = {"xx": ["ka", "to", "mi", "ru"], "yy": ["sch", "ung", "ver", "ein"], "zz": ["eau", "que", "lle", "oi"]}
    docs = []
    for i in range(450):
        lang = list(parts)[i % 3]
        docs.append((i, " ".join("".join(r.choice(parts[lang]) for _ in range(r.randrange(1, 4))) for _ in range(r.randrange(5, 400))), lang))
    docs += [(1000, None, "xx"), (1001, "123 !!", "yy"), (1002, "kato", None)]
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = fit(d)
    got = {x.doc_id: x for x in identify(d.select("doc_id", "text"), model).collect()}
    held = [(i, lang) for i, _, lang in docs[:450] if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(got[i].lang_pred == lang for i, lang in held) >= 0.97 * len(held)
    assert (got[1000].lang_pred, got[1000].score, got[1001].lang_pred) == ("und", 0.0, "und") and got[1002].lang_pred == "xx"
    kept = known_language(edge_docs)
    assert kept.columns == edge_docs.columns and {None, 0, 1, 2, 13} & {x.doc_id for x in kept.collect()} <= {None}
    assert {x.lang_pred for x in identify(edge_docs.select("doc_id", "text"), fit(no_docs)).collect()} == {"und"}
    assert known_language(no_docs).collect() == []
