"""Packing by vector bin packing: pieces under limits on tokens, segments and loss-bearing tokens.

A document's prompt, the tokens through its first line break, bears no loss; the rest does.  A
document beyond the limits is cut into pieces as large as they allow and a rest.  Rests go
into sequences by the dot-product heuristic: among the pieces that fit under all limits, the
one whose demand vector has the largest dot product with what is left of the limits, each
dimension weighted by how scarce it is.  A gap that nothing fits is filled by the head of the
piece that can give most: a prompt where only loss-bearing room is used up.  Every task packs the
rows it reads in rounds of bounded rows and bytes, so nothing is shuffled.  Small partitions are read
by one task together, so that few sequences are left open whatever the table's layout.

Defined results: null or empty text has just the end id; a text without a line break, or with
none before its end, has its first token as prompt; repeated rows are packed each on their own;
an empty table gives an empty result; other columns are not read.  Texts of one token reach the
limit on segments before that on tokens, and their sequences are padded.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import mapped, slices
from larder.llm.tokens import Encoder

TOKENS = 2048
SEGMENTS = 1024
#: Loss-bearing tokens of a sequence: 31 of 32, so that each needs prompts to be full.
LOSS = 1984
#: Gaps up to this many tokens stay padding; larger ones are filled by cutting a piece.
SLACK = 16
_ROUND = 8 << 20
#: Rows of one round at most, and bytes of text that a task has at least (if the table has them).
_ROWS, TASK_BYTES = 16_384, 8 << 20


def pack(tokens: np.ndarray, loss: np.ndarray, limits: tuple[int, int, int]) -> tuple[np.ndarray, ...]:
    """Pieces (item, start, length, sequence, offset) of items with ``tokens`` tokens.

    ``loss`` tokens of an item bear loss, the last ones of it; limits are on tokens, segments
    and loss-bearing tokens of a sequence.
    """
    most, segments, most_loss = limits
    out: list[tuple[int, int, int, int, int]] = []
    left = tokens.astype(np.int64).copy()
    quiet = left - loss.astype(np.int64)  # leading tokens without loss
    start = np.zeros(len(left), np.int64)
    rooms: list[tuple[int, int]] = []  # tokens and loss that the sequences of long items leave
    for i in np.flatnonzero((left > most) | (left - quiet > most_loss)).tolist():
        while left[i] > most or left[i] - quiet[i] > most_loss:
            n = min(most, int(quiet[i]) + most_loss)
            out.append((i, int(start[i]), n, len(rooms), 0))
            rooms.append((most - n, most_loss - max(0, n - int(quiet[i]))))
            start[i] += n
            left[i] -= n
            quiet[i] = max(0, int(quiet[i]) - n)
    pool = np.flatnonzero(left > 0)
    need = np.array([left.sum() / most, len(pool) / segments, np.maximum(left - quiet, 0)[pool].sum() / most_loss])
    weight = need / max(need.max(initial=0.0), 1e-9)
    value = left[pool] * (weight[0] / most) + (left - quiet)[pool] * (weight[2] / most_loss)
    pool = pool[np.argsort(-value, kind="stable")]
    live, still, bears = left[pool], quiet[pool], (left - quiet)[pool]  # gone: nothing left, and no room for its loss
    n_left, sequence = len(pool), 0
    while n_left:
        if sequence < len(rooms):
            room, room_loss = rooms[sequence]
            offset, parts = most - room, 1
        else:
            room, room_loss, offset, parts = most, most_loss, 0, 0
        while n_left and room and parts < segments:
            # weighted dot product of demand and room; the segments' term is the same for all
            score = live * (weight[0] * room / most**2) + bears * (weight[2] * room_loss / most_loss**2)
            score[(live > room) | (bears > room_loss)] = -1.0
            j = int(score.argmax())
            if score[j] >= 0:
                n = int(live[j])
            else:
                give = np.minimum(np.minimum(live, still + room_loss), room)
                j = int(give.argmax())
                n = int(give[j])
                if room <= SLACK or n <= SLACK and offset:
                    break
            i = int(pool[j])
            out.append((i, int(start[i]), n, sequence, offset))
            borne = max(0, n - int(still[j]))
            start[i] += n
            offset, parts, room, room_loss = offset + n, parts + 1, room - n, room_loss - borne
            live[j] -= n
            still[j] = max(0, int(still[j]) - n)
            bears[j] -= borne
            if not live[j]:
                still[j], bears[j] = -(most_loss + 1), most_loss + 1
                n_left -= 1
        if 2 * n_left < len(pool):
            kept = np.flatnonzero(live > 0)
            pool, live, still, bears = pool[kept], live[kept], still[kept], bears[kept]
        sequence += 1
    cols = np.array(out, np.int64).reshape(-1, 5)
    return tuple(cols[:, c] for c in range(5))


def prompts(ids: np.ndarray, tokens: np.ndarray, breaks: np.ndarray) -> np.ndarray:
    """Leading tokens without loss of texts of ``tokens`` ids each: through the first line break, if more than the end id follows."""
    ends = np.cumsum(tokens)
    starts = ends - tokens
    at = np.append(np.flatnonzero(breaks[ids]), len(ids))
    first = at[np.searchsorted(at, starts)]
    return np.where(first < ends - 2, first - starts + 1, 1)


def _rounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Small batches of a task put together up to the bounds of a round; larger ones go on as they are, without a copy."""
    held: list[pa.RecordBatch] = []
    rows = size = 0
    for batch in batches:
        if held and (rows + batch.num_rows > _ROWS or size + batch.nbytes > _ROUND):
            yield held.pop() if len(held) == 1 else pa.concat_batches(held)
            held, rows, size = [], 0, 0
        if batch.nbytes > _ROUND:
            yield batch
            continue
        held.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
    if held:
        yield pa.concat_batches(held)


def packed(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    limits: tuple[int, int, int] = (TOKENS, SEGMENTS, LOSS),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row a piece, with the loss-bearing tokens in it."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer)
        end = np.array([end_id], encoder.dtype).tobytes()
        base = TaskContext.get().partitionId() << 36
        for whole in _rounds(batches):
            for batch in slices(whole, "text", _ROUND):
                raw = [x + end for x in encoder.encode([t or "" for t in batch.column(1).to_pylist()])]
                tokens = np.array([len(x) // encoder.dtype.itemsize for x in raw], np.int64)
                ids = np.frombuffer(b"".join(raw), encoder.dtype)
                quiet = prompts(ids, tokens, encoder.breaks)
                item, start, length, sequence, offset = pack(tokens, tokens - quiet, limits)
                wide = memoryview(ids.astype("<u4").tobytes())
                at = (np.cumsum(tokens) - tokens)[item] + start
                crc = [zlib.crc32(wide[4 * s : 4 * (s + n)]) for s, n in zip(at.tolist(), length.tolist(), strict=True)]
                cols = [
                    batch.column(0).take(pa.array(item)),
                    pa.array(start),
                    pa.array(length),
                    pa.array(crc, pa.int64()),
                    pa.array(tokens[item]),
                    pa.array(sequence + base),
                    pa.array(offset),
                    pa.array(length - np.clip(quiet[item] - start, 0, length)),
                ]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens"]
                yield pa.RecordBatch.from_arrays(cols, names)
                base += int(sequence.max(initial=-1)) + 1

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)) + F.count(F.lit(1))).first()[0]
    rows = rows.coalesce(max(1, total // TASK_BYTES))  # neighbours are read by one task; more partitions than there are it never makes
    schema = f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long"
    return mapped(rows, run, schema, keeps=True)
