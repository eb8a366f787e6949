"""Licence scan by ordered signature rules, in built-in SQL functions only.

A text is reduced to words with single spaces.  A keyword pass finds which rules can match
at all; only those are run.  Each match is an interval of words.  An interval that lies in
another one of the same or a stronger tier is suppressed.

Defined results: null or empty text has no words and no matches; an all-separator text the
same; repeated rows give repeated results; other columns of the input never clash, as only
the id and the text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.license_rules import BASE, CONFIDENCE, rules

#: Marks around a match; both are separators, so no text has them.
OPEN, CLOSE = "\x01", "\x02"
HITS = "array<struct<start:int,back:int,tier:int,rule:int,label:string>>"
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _trie(words: list[str]) -> str:
    """One alternation, grouped by first letter so that most words fail on one test."""
    by: dict[str, list[str]] = {}
    for w in sorted(set(words)):
        by.setdefault(w[0], []).append(w[1:])
    return "|".join(f"{c}(?:{'|'.join(sorted(rest, key=len, reverse=True))})" for c, rest in by.items())


def _bounded(pattern: str) -> str:
    return f"(?i)(?<= )(?:{pattern})(?= )"


def _rule_array(table: list[tuple[str, int, list[str], str]]) -> str:
    quote = lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
    entries = ", ".join(
        f"named_struct('rule', {i}, 'label', {quote(label)}, 'tier', {tier}, "
        f"'keys', array({', '.join(map(quote, keys))}), 'pattern', {quote(_bounded(pattern))})"
        for i, (label, tier, keys, pattern) in enumerate(table)
    )
    return f"array({entries})"


def _spaces(text: Column) -> Column:
    return (F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))).cast("int")


def _places(words: Column, pattern: Column) -> Column:
    """array<struct<start,end>> in words.  Matches are marked where they begin and end; the marked words tell their numbers.

    The text starts with a space, so word i is entry i + 1 of the split.
    """
    marked = F.split(F.regexp_replace(words, pattern, F.lit(OPEN + "$0" + CLOSE)), " ", -1)
    at = lambda ws, holds: F.filter(F.transform(ws, lambda w, i: F.when(holds(w), i)), lambda i: i.isNotNull())

    def places(ws: Column) -> Column:
        opened, closed = at(ws, lambda w: F.startswith(w, F.lit(OPEN))), at(ws, lambda w: F.endswith(w, F.lit(CLOSE)))
        return F.zip_with(opened, closed, lambda a, b: F.struct((a - 1).alias("start"), b.alias("end")))

    return F.when(F.regexp_like(words, pattern), _once(marked, places)).otherwise(F.expr("cast(array() as array<struct<start:int,end:int>>)"))


def _once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _detections(words: Column, keys: Column, table: str) -> Column:
    """All matches of the rules whose keywords the text holds."""
    live = F.filter(F.expr(table), lambda r: F.arrays_overlap(r["keys"], keys))
    hits = F.transform(
        live,
        lambda r: F.transform(
            _places(words, r["pattern"]),
            lambda p: F.struct(
                p["start"].alias("start"),
                (-p["end"]).alias("back"),
                r["tier"].alias("tier"),
                r["rule"].alias("rule"),
                r["label"].alias("label"),
            ),
        ),
    )
    return F.flatten(hits)


def _unsuppressed(hits: Column) -> Column:
    """Sweep by start, longest first; ``reach[t]`` is the furthest end so far of tiers up to t.

    The sweep goes in runs of about the square root of all matches, so that no step copies more than a run.
    """
    return _once(F.sort_array(hits), _swept)


def _swept(some: Column) -> Column:
    length = F.greatest(F.ceil(F.sqrt(F.size(some))).cast("int"), F.lit(1))
    reach = F.array_repeat(F.lit(-1), len(CONFIDENCE))
    none = F.expr(f"cast(array() as {HITS})")
    one = lambda acc, d: F.struct(
        F.when(F.get(acc["reach"], d["tier"]) >= -d["back"], acc["kept"]).otherwise(F.concat(acc["kept"], F.array(d))).alias("kept"),
        F.transform(acc["reach"], lambda v, t: F.when(t >= d["tier"], F.greatest(v, -d["back"])).otherwise(v)).alias("reach"),
    )

    def run(acc: Column, part: Column) -> Column:
        swept = F.aggregate(part, F.struct(none.alias("kept"), acc["reach"].alias("reach")), one)
        return _once(swept, lambda x: F.struct(F.concat(acc["kept"], F.array(x["kept"])).alias("kept"), x["reach"].alias("reach")))

    runs = F.transform(
        F.sequence(F.lit(0), F.greatest(F.floor((F.size(some) - 1) / length).cast("int"), F.lit(0))), lambda k: F.slice(some, k * length + 1, length)
    )
    zero = F.struct(F.expr(f"cast(array() as array<{HITS}>)").alias("kept"), reach.alias("reach"))
    return F.flatten(F.aggregate(runs, zero, run, lambda acc: acc["kept"]))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_words, base matches, and kept detections with their word spans."""
    table = rules()
    base = [(label, 0, keys, phrase) for label, keys, phrase in BASE]
    keywords = [k for _, _, keys, _ in [*table, *base] for k in keys]
    trimmed = F.trim(F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), SEPARATORS, " "))
    step = docs.select(F.col(id_col).alias("doc_id"), trimmed.alias("_trimmed"))
    step = step.select(
        "doc_id",
        F.when(F.col("_trimmed") == "", F.lit(0)).otherwise(_spaces(F.col("_trimmed")) + 1).cast("long").alias("n_words"),
        F.concat(F.lit(" "), F.col("_trimmed"), F.lit(" ")).alias("_words"),
    )
    key_pattern = F.lit(f"(?i)(?<= )(?:{_trie(keywords)})(?= )")
    step = step.withColumn(
        "_keys",
        F.array_distinct(F.transform(F.regexp_extract_all("_words", key_pattern, F.lit(0)), lambda k: F.lower(k))),
    )
    none = F.expr(f"cast(array() as {HITS})")
    some = F.size("_keys") > 0
    step = step.withColumn(
        "_base", F.when(some, _detections(F.col("_words"), F.col("_keys"), _rule_array(base))).otherwise(none)
    ).withColumn(
        "_kept",
        F.when(some, _unsuppressed(_detections(F.col("_words"), F.col("_keys"), _rule_array(table)))).otherwise(none),
    )
    return step.select(
        "doc_id",
        "n_words",
        F.transform("_base", lambda d: F.struct(d["label"].alias("label"), d["start"].alias("start"))).alias("base"),
        F.transform(
            "_kept",
            lambda d: F.struct(
                d["label"].alias("label"),
                d["tier"].alias("tier"),
                d["rule"].alias("rule"),
                d["start"].alias("start"),
                (-d["back"]).alias("end"),
            ),
        ).alias("detections"),
    )


def scan_query(docs: DataFrame) -> DataFrame:
    """The contract's columns from :func:`scan`; score is the strongest confidence of a detection."""
    weights = F.array(*[F.lit(c) for c in CONFIDENCE])
    labels = lambda column: F.transform(column, lambda d: d["label"])
    starts = F.transform("base", lambda d: d["start"].cast("long"))
    joined = lambda a: F.array_join(F.sort_array(F.array_distinct(a)), ",")
    return scan(docs).select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(labels("base")).alias("base_labels"),
        joined(F.concat(labels("base"), labels("detections"))).alias("labels"),
        F.coalesce(
            F.array_max(F.transform("detections", lambda d: F.get(weights, d["tier"]))), F.lit(0.0)
        ).alias("score"),
        F.size("detections").cast("long").alias("n_detections"),
    )
