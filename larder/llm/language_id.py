"""Language identification by prediction by partial matching over bytes.

Training counts, per language, every context of up to ``ORDER`` bytes and the byte that
follows, over a bounded sample of labelled rows.  The counts are then frozen: a byte costs
the escapes from each longer context that has not seen it, plus its code length in the
longest one that has (method C escapes, no exclusion; below order 0 all 256 bytes are equal).
A text's language is the one whose model gives the shortest code.  Up to TABLE_LANGUAGES
languages share one table an order, so that a lookup gives the costs of all of them at once.

Defined results: null text or text without a letter gives ``und`` and score 0; empty text
the same; rows with null language are never trained on; without any training row all rows
are ``und``; repeated rows repeat; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import forget, release, whole_rows

#: Longest context in bytes.
ORDER = 4
#: Bounds of the training sample: rows and bytes of one language.  Every label is learned.
SAMPLE_ROWS = 600
SAMPLE_BYTES = 1_500_000
#: Longer texts come after all others in the sample, so one is trained on only where a language has nothing else.
LONG_TEXT_BYTES = 60_000
#: Languages of one table; a table's size grows with their square.
TABLE_LANGUAGES = 8
_PIECE = 8 << 20
#: Characters of the texts that are judged together.
_ROUND = 2 << 20
_LETTER = regex.compile(r"\p{L}")
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Table:
    """Open-addressing hash table from packed bytes to a row of costs, one column a language."""

    keys: np.ndarray
    rows: np.ndarray
    slots: np.ndarray
    shift: int

    @classmethod
    def build(cls, keys: np.ndarray, rows: np.ndarray) -> Table:
        bits = max(8, int(len(keys) * 2).bit_length())
        slots, shift = np.full(1 << bits, -1, np.int32), 64 - bits
        left = np.arange(len(keys))
        at = ((keys * _MIX) >> np.uint64(shift)).astype(np.int64)
        while len(left):
            free = slots[at] < 0
            slots[at[free]] = left[free]
            lost = slots[at] != left
            left, at = left[lost], (at[lost] + 1) & (len(slots) - 1)
        return cls(keys, rows.astype(np.float32), slots, shift)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Row of each key, -1 where the table lacks it."""
        if not len(self.keys):
            return np.full(len(wanted), -1, np.int64)
        at = ((wanted * _MIX) >> np.uint64(self.shift)).astype(np.int64)
        found = self.slots[at].astype(np.int64)
        todo = np.flatnonzero((found >= 0) & (self.keys[found] != wanted))
        while len(todo):
            at[todo] = (at[todo] + 1) & (len(self.slots) - 1)
            found[todo] = self.slots[at[todo]]
            todo = todo[(found[todo] >= 0) & (self.keys[found[todo]] != wanted[todo])]
        return found


@dataclass
class Part:
    """Tables of some of the languages."""

    languages: list[str]
    #: By order n: costs of (n context bytes, byte) that some language has seen in that context.
    symbols: list[Table]
    #: By order n: escape cost of n context bytes, 0 where a language has not seen them.
    escapes: list[Table]


@dataclass
class Model:
    languages: list[str]
    #: Tables of the languages, in their order.
    parts: list[Part]


def _grams(data: np.ndarray, n: int) -> np.ndarray:
    """Packed n-byte grams at every start."""
    out = np.zeros(max(0, len(data) - n + 1), np.uint64)
    for i in range(n):
        out = (out << np.uint64(8)) | data[i : len(data) - n + 1 + i].astype(np.uint64)
    return out


def train(samples: dict[str, list[bytes]], order: int = ORDER) -> Model:
    """Frozen cost tables from the texts of each language."""
    languages = sorted(samples)
    groups = [languages[i : i + TABLE_LANGUAGES] for i in range(0, len(languages), TABLE_LANGUAGES)]
    return Model(languages, [_train_part(group, samples, order) for group in groups])


def _train_part(languages: list[str], samples: dict[str, list[bytes]], order: int) -> Part:
    counts: list[list[tuple[np.ndarray, np.ndarray]]] = []  # [language][order] -> grams of order + 1 bytes, counts
    for language in languages:
        # order zero bytes before each text stand for its start; contexts never cross texts
        joined = np.frombuffer(b"".join(b"\0" * order + t for t in samples[language]), np.uint8)
        own = []
        for n in range(order + 1):
            grams = _grams(joined[order - n :], n + 1)
            sizes = [order + len(t) for t in samples[language]]
            real = np.concatenate([np.r_[np.zeros(order, bool), np.ones(s - order, bool)] for s in sizes] or [np.zeros(0, bool)])
            own.append(np.unique(grams[real[order:]], return_counts=True) if len(grams) else (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
        counts.append(own)
    symbols, escapes = [], []
    for n in range(order + 1):
        keys = np.unique(np.concatenate([own[n][0] for own in counts] or [np.zeros(0, np.uint64)]))
        contexts = np.unique(keys >> np.uint64(8))
        cost = np.zeros((len(keys), len(languages)), np.float64)
        escape = np.zeros((len(contexts), len(languages)), np.float64)
        for j, own in enumerate(counts):
            grams, seen = own[n]
            which = np.searchsorted(contexts, grams >> np.uint64(8))
            total = np.bincount(which, seen, minlength=len(contexts))
            kinds = np.bincount(which, minlength=len(contexts))
            known = kinds > 0
            escape[known, j] = -np.log2(kinds[known] / (total[known] + kinds[known]))
            mine = np.searchsorted(keys, grams)
            # a symbol that this language lacks here: its escape and its cost one order down
            context = np.searchsorted(contexts, keys >> np.uint64(8))
            lower = np.full(len(keys), 8.0)
            if n:
                low = symbols[n - 1]
                at = low.find(keys & np.uint64((1 << (8 * n)) - 1))
                lower = low.rows[at, j].astype(np.float64)
            cost[:, j] = escape[context, j] + lower
            cost[mine, j] = -np.log2(seen / (total[which] + kinds[which]))
        symbols.append(Table.build(keys, cost))
        escapes.append(Table.build(contexts, escape))
    return Part(languages, symbols, escapes)


def byte_costs(model: Part, data: bytes) -> np.ndarray:
    """Bits for each byte under each language; the text's start stands for missing context."""
    order = len(model.symbols) - 1
    padded = np.frombuffer(b"\0" * order + data, np.uint8)
    grams = _grams(padded, order + 1)
    out = np.zeros((len(grams), len(model.languages)), np.float32)
    todo = np.arange(len(grams))
    for n in range(order, -1, -1):
        mask = np.uint64((1 << (8 * (n + 1))) - 1)
        wanted = grams[todo] & mask if n < order else grams
        at = model.symbols[n].find(wanted)
        hit = at >= 0
        if n == order and hit.all():
            return model.symbols[n].rows[at]
        out[todo[hit]] += model.symbols[n].rows[at[hit]]
        todo, wanted = todo[~hit], wanted[~hit]
        if not len(todo):
            return out
        context = model.escapes[n].find(wanted >> np.uint64(8))
        seen = context >= 0
        out[todo[seen]] += model.escapes[n].rows[context[seen]]
    out[todo] += np.float32(8.0)
    return out


def code_lengths(model: Model, texts: list[bytes]) -> np.ndarray:
    """Bits of each text under each language, exact sums over the whole text."""
    return np.concatenate([np.zeros((len(texts), 0))] + [_part_lengths(part, texts) for part in model.parts], axis=1)


def _part_lengths(model: Part, texts: list[bytes]) -> np.ndarray:
    order = len(model.symbols) - 1
    out = np.zeros((len(texts), len(model.languages)), np.float64)
    group: list[int] = []
    held = 0

    def flush() -> None:
        # one pass over many short texts, parted by their start marks
        joined = (b"\0" * order).join(texts[i] for i in group)
        costs = byte_costs(model, joined)
        at = 0
        starts = []
        for i in group:
            starts.append(at)
            at += len(texts[i]) + order
        for i, s in zip(group, starts, strict=True):
            out[i] = costs[s : s + len(texts[i])].sum(axis=0, dtype=np.float64)

    for i, text in enumerate(texts):
        for s in range(0, len(text), _PIECE) if len(text) > _PIECE else ():
            lead = text[max(0, s - order) : s]
            out[i] += byte_costs(model, lead + text[s : s + _PIECE])[len(lead) :].sum(axis=0, dtype=np.float64)
        if len(text) > _PIECE:
            continue
        if group and held + len(text) > (1 << 18):
            flush()
            group, held = [], 0
        group.append(i)
        held += len(text) + order
    if group:
        flush()
    return out


def training_rows(labelled: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """The bounded sample: by language, whole texts that come first by a hash of id and text, those beyond LONG_TEXT_BYTES last.

    Rows are taken up to SAMPLE_ROWS and as long as those before them have fewer than SAMPLE_BYTES, so the first is always taken.
    """
    data = F.col(text_col).cast("binary")
    kept = labelled.where(F.col(lang_col).isNotNull() & (F.octet_length(text_col) > 0)).select(
        F.col(lang_col).alias("lang"), data.alias("data"), F.xxhash64(F.col(id_col), F.col(text_col), F.lit(7)).alias("h"), (F.octet_length(data) > LONG_TEXT_BYTES).alias("long")
    )
    # a cut of the hash that leaves a few times the sample, so that only those rows are ranked; copies share a hash
    counts = kept.groupBy("lang", "long").agg(F.approx_count_distinct("h").alias("n"))
    short = counts.groupBy("lang").agg(F.max(~F.col("long")).alias("short"))
    cuts = counts.join(short, "lang").where(~F.col("long") | ~F.col("short"))  # long texts only where there is nothing else
    most = F.when(F.col("long"), 3.0 * (SAMPLE_BYTES // LONG_TEXT_BYTES + 20)).otherwise(3.0 * (SAMPLE_ROWS + 20))
    near = kept.join(F.broadcast(cuts), ["lang", "long"]).where(F.pmod("h", F.lit(1 << 20)) * F.col("n") < most * (1 << 20))
    by = Window.partitionBy("lang").orderBy("h", "data")
    first = near.select("lang", "h", "data").withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= SAMPLE_ROWS)
    before = F.sum(F.octet_length("data").cast("long")).over(Window.partitionBy("lang").orderBy("rank")) - F.octet_length("data")
    return first.withColumn("before", before).where(F.col("before") < SAMPLE_BYTES).select("lang", "rank", "data")


def fit(
    labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", order: int = ORDER
) -> Model:
    """Train on at most SAMPLE_ROWS whole rows a language, as many as reach SAMPLE_BYTES bytes."""
    samples: dict[str, list[bytes]] = {}
    for row in sorted(training_rows(labelled, id_col, text_col, lang_col).collect(), key=lambda r: (r["lang"], r["rank"])):
        samples.setdefault(row["lang"], []).append(bytes(row["data"]))
    return train(samples, order)


def verdicts(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score in [0, 1] and bits a byte of each text."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    bits = code_lengths(model, raw)
    sizes = np.maximum(1, np.fromiter(map(len, raw), np.int64, len(raw)))
    known = np.array([bool(model.languages) and t is not None and _LETTER.search(t) is not None for t in texts], bool)
    if not model.languages:
        return ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
    best = bits.argmin(axis=1)
    least = bits.min(axis=1)
    # share of the best language if up to 64 bits of the difference in code length count
    odds = np.exp2(np.maximum(-64.0, (least[:, None] - bits)))
    score = np.where(known, 1.0 / odds.sum(axis=1), 0.0)
    return [model.languages[b] if k else "und" for b, k in zip(best, known, strict=True)], score, np.where(known, least / sizes, 0.0)


def _rounds(texts: pd.Series) -> Iterator[list[str | None]]:
    """A batch in parts of a bounded size (one at least), so that the bytes of all its texts are never held at once."""
    some: list[str | None] = []
    held = 0
    for t in texts:
        t = t if isinstance(t, str) else None
        if some and held + len(t or "") > _ROUND:
            yield some
            some, held = [], 0
        some.append(t)
        held += len(t or "")
    yield some


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """(row, verdict): all columns of ``docs`` as one struct, and struct<lang, score, bits_per_byte>."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double, bits_per_byte double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        try:
            forget()
            for texts in batches:
                lang, score, bpb = zip(*(verdicts(shared.value, some) for some in _rounds(texts)), strict=True)
                yield pd.DataFrame({"lang": [x for some in lang for x in some], "score": np.concatenate(score), "bits_per_byte": np.concatenate(bpb)})
        finally:
            release()

    return docs.select(whole_rows(docs).alias("row"), judge(F.col(f"`{text_col}`")).alias("verdict"))


def held_out(id_col: str = "doc_id"):
    """crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def language_id_query(docs: DataFrame) -> DataFrame:
    """The contract's columns: trained on the rows that are not held out, predicted for all."""
    model = fit(docs.where(~held_out()))
    return identify(docs.select("doc_id", "text"), model).select(
        "row.doc_id",
        held_out("row.doc_id").alias("held_out"),
        F.col("verdict.lang").alias("lang_pred"),
        F.col("verdict.score").alias("score"),
        F.col("verdict.bits_per_byte").alias("bits_per_byte"),
    )
