"""Canonical length-limited Huffman coding of token ids, in blocks with bit-offset checkpoints."""

from __future__ import annotations

import struct
import zlib

import numpy as np

#: Longest code in bits: the decoding table has 2**LIMIT entries.
LIMIT = 18
#: Ids of one block; a checkpoint holds the bit at which the block starts.
BLOCK = 512
_STRIDE = 512 * BLOCK
MAGIC = b"LHUF0001"


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code length of every symbol with at most ``limit`` bits (package-merge); 0 where unused."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n == 0:
        return out
    if n == 1:
        out[used] = 1
        return out
    if n > 1 << limit:
        raise ValueError(f"{n} symbols don't fit in codes of {limit} bits")
    order = np.argsort(counts[used], kind="stable")
    leaves = counts[used][order].astype(np.float64)
    levels = []  # which entries of each level's sorted list are leaves
    packages = np.zeros(0)
    for _ in range(limit):
        both = np.concatenate([leaves, packages])
        is_leaf = np.concatenate([np.ones(n, bool), np.zeros(len(packages), bool)])
        by = np.argsort(both, kind="stable")
        levels.append(is_leaf[by])
        both = both[by]
        pairs = len(both) // 2
        packages = both[0 : 2 * pairs : 2] + both[1 : 2 * pairs : 2]
    lengths = np.zeros(n, np.int64)
    take = 2 * (n - 1)
    for level in reversed(levels):
        chosen = int(level[:take].sum())
        lengths[:chosen] += 1  # the lightest symbols come first in every level
        take = 2 * (take - chosen)
    out[used[order]] = lengths
    return out


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then symbol."""
    codes = np.zeros(len(lengths), np.uint64)
    code, before = 0, 0
    for length in range(1, int(lengths.max(initial=0)) + 1):
        code <<= length - before
        before = length
        which = np.flatnonzero(lengths == length)
        codes[which] = np.arange(code, code + len(which), dtype=np.uint64)
        code += len(which)
    return codes


def encode_bits(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bit stream as big-endian 32-bit words, and the bit at which each block starts."""
    total = int(sum(int(lengths[ids[at : at + _STRIDE]].sum(dtype=np.int64)) for at in range(0, len(ids), _STRIDE)))
    words = np.zeros(total // 64 + 2, np.uint64)
    marks, base = [], 0
    for at in range(0, len(ids), _STRIDE):
        some = ids[at : at + _STRIDE]
        size = lengths[some].astype(np.int64)
        end = np.cumsum(size) + base
        start = end - size
        base = int(end[-1])
        marks.append(start[::BLOCK].copy())
        word, room = start >> 6, 64 - (start & 63) - size
        code = codes[some]
        fits = np.where(room >= 0, code << np.maximum(room, 0).astype(np.uint64), code >> np.maximum(-room, 0).astype(np.uint64))
        new = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        words[word[new]] |= np.bitwise_or.reduceat(fits, new)
        over = np.flatnonzero(room < 0)  # at most one code a word runs into the next
        words[word[over] + 1] |= code[over] << (64 + room[over]).astype(np.uint64)
    stream = words.astype(">u8").view(">u4")[: (total + 31) // 32]
    return stream, np.concatenate(marks) if marks else np.zeros(0, np.int64)


def decode_table(lengths: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, int]:
    """symbol * 32 + length for every possible next ``bits`` bits."""
    bits = max(1, int(lengths.max(initial=0)))
    table = np.zeros(1 << bits, np.uint32)
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((codes[used], lengths[used]))]
    spans = 1 << (bits - lengths[order].astype(np.int64))
    filled = np.repeat(order.astype(np.uint32) * 32 + lengths[order], spans)
    table[: len(filled)] = filled
    return table, bits


def decode_bits(stream: np.ndarray, starts: np.ndarray, n: int, table: np.ndarray, bits: int) -> np.ndarray:
    """All blocks side by side: every step reads one id of each block through the table."""
    words = np.r_[stream.astype(np.uint64), np.zeros(2, np.uint64)]
    last = len(words) - 2
    at = starts.astype(np.int64).copy()
    out = np.zeros((min(BLOCK, n), len(starts)), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for k in range(out.shape[0]):
        w = np.minimum(at >> 5, last)
        window = (words[w] << np.uint64(32)) | words[w + 1]
        entry = table[((window >> (64 - bits - (at & 31)).astype(np.uint64)) & mask).astype(np.int64)]
        out[k] = entry >> np.uint32(5)
        at += entry & np.uint32(31)
    return out.T.reshape(-1)[:n]


def pack_file(doc_ids: np.ndarray, sizes: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> bytes:
    """One self-contained file: code lengths, document table, checkpoints, bit stream."""
    stream, starts = encode_bits(ids, lengths, canonical_codes(lengths))
    table = zlib.compress(lengths.astype(np.uint8).tobytes(), 6)
    docs = zlib.compress(doc_ids.astype("<i8").tobytes() + sizes.astype("<i8").tobytes(), 1)
    marks = zlib.compress(np.diff(starts, prepend=0).astype("<u4").tobytes(), 1)
    head = struct.pack("<8sQQIQQQ", MAGIC, len(doc_ids), len(ids), BLOCK, len(table), len(docs), len(marks))
    return b"".join([head, table, docs, marks, stream.tobytes()])


def unpack_file(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc_ids, sizes and ids of a file."""
    magic, n_docs, n_ids, block, n_table, n_of_docs, n_marks = struct.unpack_from("<8sQQIQQQ", data)
    if magic != MAGIC or block != BLOCK:
        raise ValueError("not a token file of this format")
    at = struct.calcsize("<8sQQIQQQ")
    lengths = np.frombuffer(zlib.decompress(data[at : at + n_table]), np.uint8)
    at += n_table
    both = np.frombuffer(zlib.decompress(data[at : at + n_of_docs]), "<i8")
    at += n_of_docs
    starts = np.cumsum(np.frombuffer(zlib.decompress(data[at : at + n_marks]), "<u4").astype(np.int64))
    at += n_marks
    table, bits = decode_table(lengths, canonical_codes(lengths))
    ids = decode_bits(np.frombuffer(data, ">u4", offset=at), starts, n_ids, table, bits)
    return both[:n_docs], both[n_docs:], ids
