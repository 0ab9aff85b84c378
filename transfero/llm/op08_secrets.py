"""Secret scans (DataFrame and SQL functions only): fixed patterns, and character Markov models.

Patterns give spans of three kinds. Two first-order character models, one of random strings and one of
ordinary identifiers, score every other token of at least ``MIN_TOKEN`` characters: the mean
log-likelihood ratio per character pair, in nats, above ``threshold`` adds a span of kind ``markov``.
The models are trained from labelled samples: values of pattern spans are random strings, other tokens
of the sample, where two documents share them, are ordinary. The sample is about ``sample`` documents with a pattern span and as many
of all documents, chosen by hash, never more than twice that; the scan reads every document whole.

Match places come from the gaps between matches: ``split`` gives the gaps and ``regexp_extract_all`` the
matches of the same leftmost, non-overlapping search, and running lengths give code-point offsets.

Defined results: null text is empty; no spans give counts 0, an empty ``spans`` and the hash of the
empty string; repeated rows give repeated rows; other columns are ignored; an empty table gives no rows;
without any labelled sample the models are equal and add nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_sample, let, store, table

#: Fixed patterns of the contract; kinds rank in this order.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "markov")
MIN_TOKEN, THRESHOLD, SAMPLE, DRAW = 20, 0.8, 2000, 5.0
#: Maximal runs that the models score.
TOKEN = r"[A-Za-z0-9+/_=-]{%d,}" % MIN_TOKEN
SPAN = "array<struct<start:bigint,kind:int,end:bigint>>"
#: Spans that one step of a fold over a text's spans may hold.
CHUNK = 128


def in_chunks(values: Column, total, join, body, chunk: int = CHUNK) -> Column:
    """``body(part, before)`` of every part of ``chunk`` values, where ``before`` joins the totals of the parts ahead.

    A fold that appends to an array or a text copies what it has at every step; in parts it copies no more than a
    part, and the totals ahead are one number a part.
    """
    parts = F.transform(F.sequence(F.lit(0), F.floor((F.greatest(F.size(values), F.lit(1)) - 1) / chunk).cast("int")),
                        lambda c: F.slice(values, c * chunk + 1, F.lit(chunk)))

    def each(parts: Column) -> Column:
        before = F.aggregate(F.transform(parts, lambda part: total(part)), F.array(F.lit(0).cast("long")),
                             lambda a, t: F.concat(a, F.array(join(F.element_at(a, F.lit(-1)), t))))
        return let(before, lambda b: F.transform(parts, lambda part, i: body(part, F.get(b, i))))

    return let(parts, lambda p: each(p))


def matches(text: Column, pattern: str, kind: int, keep) -> Column:
    """Spans (start, kind, end) of the matches of ``pattern`` that ``keep`` accepts; ends are exclusive."""
    def spans(found: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        steps = F.zip_with(gaps, found, lambda g, m: F.struct(F.length(g).cast("long").alias("gap"), F.coalesce(F.length(m), F.lit(0)).cast("long").alias("len"), F.coalesce(keep(m), F.lit(False)).alias("ok")))

        def add(a: Column, x: Column) -> Column:
            end = a["at"] + x["gap"] + x["len"]
            span = F.struct((a["at"] + x["gap"]).alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
            return F.struct(end.alias("at"), F.when(x["ok"], F.concat(a["spans"], F.array(span))).otherwise(a["spans"]).alias("spans"))

        placed = let(steps, lambda st: F.flatten(in_chunks(
            st, lambda part: F.aggregate(part, F.lit(0).cast("long"), lambda a, x: a + x["gap"] + x["len"]), lambda a, t: a + t,
            lambda part, at: F.aggregate(part, F.struct(at.alias("at"), F.array().cast(SPAN).alias("spans")), add, lambda a: a["spans"]))))
        return F.when(F.exists(found, keep), placed).otherwise(F.array().cast(SPAN))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), spans)


def pattern_spans(text: Column) -> Column:
    """All pattern spans, sorted by start, then kind."""
    return F.sort_array(F.concat(
        matches(text, ASSIGN, 0, lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 12),
        # runs shorter than the limit contain no match of their own, so the limit may stand in the pattern
        matches(text, r"AKIA[A-Z0-9]{14,}", 1, lambda m: F.length(m) >= 18),
        matches(text, r"[0-9a-f]{16,}", 2, lambda m: F.length(m) >= 16)))


def _furthest(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda a, s: F.greatest(a, s["end"]))


def without(text: Column, spans: Column, marker: str) -> Column:
    """``text`` with every span of ``spans`` (sorted by start) replaced by ``marker``; a span that begins inside an
    earlier one goes with it."""
    def pieces(part: Column, at: Column) -> Column:
        stop = F.greatest(at, _furthest(part))
        own = F.substring(text, (at + 1).cast("int"), (stop - at).cast("int"))  # the part's own stretch of the text

        def cut(own: Column) -> Column:
            def add(a: Column, s: Column) -> Column:
                gap = F.substring(own, (a["at"] - at + 1).cast("int"), F.greatest(s["start"] - a["at"], F.lit(0)).cast("int"))
                return F.struct(F.greatest(a["at"], s["end"]).alias("at"),
                                F.when(s["start"] >= a["at"], F.concat(a["out"], gap, F.lit(marker))).otherwise(a["out"]).alias("out"))
            return F.aggregate(part, F.struct(at.alias("at"), F.lit("").alias("out")), add, lambda a: a["out"])

        return let(own, lambda o: cut(o))

    replaced = F.array_join(in_chunks(spans, _furthest, lambda a, t: F.greatest(a, t), pieces), "")
    return F.concat(replaced, F.substring(text, (_furthest(spans) + 1).cast("int"), F.length(text)))


def apart(spans: Column, others: Column) -> Column:
    """``spans`` (disjoint) that overlap none of ``others``; both sorted by start.

    In one order of the others' starts and the spans' ends, a span overlaps an earlier other if the furthest end so
    far lies behind its start, and none of the later ones.
    """
    item = lambda at, span, low, high: F.struct(at.alias("at"), F.lit(span).alias("other"), low.alias("low"), high.alias("high"))
    events = F.sort_array(F.concat(F.transform(spans, lambda s: item(s["end"], False, s["start"], s["end"])),
                                   F.transform(others, lambda o: item(o["start"], True, o["start"], o["end"]))))
    end = lambda a, e: F.when(e["other"], F.greatest(a, e["high"])).otherwise(a)

    def free(part: Column, before: Column) -> Column:
        def add(a: Column, e: Column) -> Column:
            keep = ~e["other"] & (a["end"] <= e["low"])
            span = F.struct(e["low"].alias("start"), F.lit(KINDS.index("markov")).alias("kind"), e["high"].alias("end"))
            return F.struct(end(a["end"], e).alias("end"), F.when(keep, F.concat(a["spans"], F.array(span))).otherwise(a["spans"]).alias("spans"))
        return F.aggregate(part, F.struct(before.alias("end"), F.array().cast(SPAN).alias("spans")), add, lambda a: a["spans"])

    total = lambda part: F.aggregate(part, F.lit(0).cast("long"), end)
    merged = let(events, lambda ev: F.flatten(in_chunks(ev, total, lambda a, t: F.greatest(a, t), free)))
    return F.when(F.size(spans) == 0, F.array().cast(SPAN)).when(F.size(others) == 0, spans).otherwise(merged)


def pairs(token: Column) -> Column:
    """Code of each pair of neighbouring characters: 128 times the first's ASCII code plus the second's."""
    return let(F.transform(F.filter(F.split(token, ""), lambda c: c != ""), lambda c: F.least(F.ascii(c), F.lit(127))), lambda c:
               F.filter(F.transform(c, lambda x, i: x * 128 + F.get(c, i + 1)), lambda x: x.isNotNull()))


def train(docs: DataFrame, sample: int = SAMPLE) -> list[float]:
    """Log-likelihood ratios (random against ordinary) of all 128 * 128 character pairs, from a bounded sample."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # cheap necessary condition, so that only likely documents are scanned for labels
    labelled = rows.filter(F.rlike("text", F.lit(rf"{ASSIGN}|AKIA[A-Z0-9]{{14}}|[0-9a-f]{{16}}")))
    labelled = store(spark, labelled, "secret-labels")
    some = bounded_sample(labelled, sample, "doc_id", "text").unionByName(bounded_sample(rows, sample, "doc_id", "text")).distinct()
    spans = some.select("text", pattern_spans(F.col("text")).alias("spans"))
    cut = lambda t, s: F.regexp_extract(F.substring(t, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")), r"([A-Za-z0-9+/_.=-]+)$", 1)
    secret = spans.select(F.explode(F.transform("spans", lambda s: cut(F.col("text"), s))).alias("token"), F.lit(True).alias("random"))
    tokens = F.regexp_extract_all(without(F.col("text"), F.col("spans"), " "), F.lit(r"[A-Za-z0-9+/_=-]{4,}"), F.lit(0))
    # an unlabelled random string hardly comes twice, an identifier does
    ordinary = (spans.select(F.explode(F.array_distinct(tokens)).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
                .filter("n > 1").select("token", F.lit(False).alias("random")))
    counted = (secret.unionByName(ordinary).select("random", F.explode(pairs(F.col("token"))).alias("pair"))
               .groupBy("pair").agg(F.count_if("random").alias("r"), F.count_if(~F.col("random")).alias("o")).collect())  # 16,384 rows at most
    r, o = [0] * 16384, [0] * 16384
    for row in counted:
        r[row["pair"]], o[row["pair"]] = row["r"], row["o"]
    if not any(r) or not any(o):
        return [0.0] * 16384
    # a pair's chance after its first character, drawn towards the second character's own frequency, which
    # is smoothed over the 66 characters that tokens have
    single_r = [(sum(r[c::128]) + 0.5) / (sum(r) + 33) for c in range(128)]
    single_o = [(sum(o[c::128]) + 0.5) / (sum(o) + 33) for c in range(128)]
    out = []
    for c in range(0, 16384, 128):
        row_r, row_o = r[c:c + 128], o[c:c + 128]
        sum_r, sum_o = sum(row_r) + DRAW, sum(row_o) + DRAW
        out += [math.log((x + DRAW * p) / sum_r) - math.log((y + DRAW * q) / sum_o) for x, y, p, q in zip(row_r, row_o, single_r, single_o)]
    return out


def scan(text: Column, model: list[float], threshold: float = THRESHOLD) -> tuple[Column, Column]:
    """(pattern spans, Markov spans that overlap none of them) of ``text``; nest the second by ``let``."""
    ratios = F.split(F.lit(",".join(f"{x:.4f}" for x in model)), ",").cast("array<double>")

    def random(token: Column) -> Column:
        return let(pairs(token), lambda p: F.aggregate(p, F.lit(0.0), lambda a, x: a + F.get(ratios, x)) / F.greatest(F.size(p), F.lit(1)) > threshold)

    return pattern_spans(text), matches(text, TOKEN, 3, random)


def secrets(docs: DataFrame, model: list[float] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``_base`` and ``_all``: sorted arrays of spans (start, kind, end), code points, end exclusive."""
    model = train(docs) if model is None else model
    text = F.coalesce(F.col("text"), F.lit(""))
    base, markov = scan(text, model, threshold)
    found = docs.withColumn("_base", base).withColumn("_markov", markov)
    return found.withColumn("_all", F.sort_array(F.concat("_base", apart(F.col("_markov"), F.col("_base"))))).drop("_markov")


def joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def redact(docs: DataFrame, marker: str = "[SECRET]", model: list[float] | None = None) -> DataFrame:
    """The rows and columns of ``docs`` with every found span in ``text`` replaced by ``marker``.

    ``n_chars``, if present, becomes the new length where a text changed.
    """
    found = secrets(docs, model)
    clean = without(F.col("text"), F.col("_all"), marker)
    changed = F.size("_all") > 0
    out = found.withColumn("_clean", F.when(changed, clean).otherwise(F.col("text")))
    columns = {"text": F.col("_clean")}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(changed, F.length("_clean").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return out.select(*[columns.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda k: F.size(F.filter("_base", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(joined(F.col("_base")), 256).alias("base_sha256"), joined(F.col("_all")).alias("spans"))
