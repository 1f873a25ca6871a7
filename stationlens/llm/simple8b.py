"""Simple-8b files of token ids: 64-bit words that each hold as many ids as fit.

The top four bits of a word select how many ids of how many bits fill the other sixty.
Ids of over sixty bits go to a list of escapes; their word holds an index into it.  A
*segment* is the file unit: blocks of ``BLOCK_IDS`` ids, the word and escape offsets of every block,
and a checksum, so that any block is decoded alone and in whole-array steps.
"""

import struct
import zlib

import numpy as np

#: Fixed values of the format: ids a word and bits an id, by selector.
PACKINGS = (
    (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8),
    (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60),
)
ESCAPE = 14
COUNTS = np.array([n for n, _ in PACKINGS] + [1, 0], dtype=np.int64)
BLOCK_IDS = 65_536
MAGIC = b"S8B1"
HEAD = struct.Struct("<4sIQIQQ")  # magic, checksum, ids, blocks, words, escapes


def encode_block(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, escapes), both unsigned 64-bit, of one array of ids."""
    ids = np.ascontiguousarray(ids, dtype=np.uint64)
    n = len(ids)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    large = ids >= np.uint64(1 << 60)
    selector = np.where(large, ESCAPE, len(PACKINGS) - 1).astype(np.int8)
    # From few to many ids a word, so that the last that fits at a place stands.
    for s in range(len(PACKINGS) - 2, -1, -1):
        count, bits = PACKINGS[s]
        if count > n:
            break
        over = np.zeros(n + 1, np.int32)
        np.cumsum(ids >= np.uint64(1 << bits), out=over[1:])
        fits = over[count:] == over[: n - count + 1]
        if not fits.any():
            break  # more ids of fewer bits can't fit either
        selector[: n - count + 1][fits] = s
    step = COUNTS[selector].tolist()
    starts, at = [], 0
    while at < n:
        starts.append(at)
        at += step[at]
    starts = np.array(starts, dtype=np.int64)
    chosen = selector[starts]
    words = chosen.astype(np.uint64) << np.uint64(60)
    for s, (count, bits) in enumerate(PACKINGS):
        at = np.flatnonzero(chosen == s)
        if len(at):
            values = ids[starts[at][:, None] + np.arange(count)]
            shifts = (np.arange(count) * bits).astype(np.uint64)
            words[at] |= np.bitwise_or.reduce(values << shifts, axis=1)
    at = np.flatnonzero(chosen == ESCAPE)
    words[at] |= np.arange(len(at), dtype=np.uint64)
    return words, ids[starts[at]]


def decode_block(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    selector = (words >> np.uint64(60)).astype(np.int8)
    counts = COUNTS[selector]
    starts = np.cumsum(counts) - counts
    out = np.empty(int(counts.sum()), np.uint64)
    for s, (count, bits) in enumerate(PACKINGS):
        at = np.flatnonzero(selector == s)
        if len(at):
            shifts = (np.arange(count) * bits).astype(np.uint64)
            mask = np.uint64((1 << bits) - 1)
            out[starts[at][:, None] + np.arange(count)] = (words[at][:, None] >> shifts) & mask
    at = np.flatnonzero(selector == ESCAPE)
    if len(at):
        out[starts[at]] = escapes[(words[at] & np.uint64((1 << 60) - 1)).astype(np.int64)]
    return out


def encode_segment(ids: np.ndarray) -> bytes:
    blocks = [encode_block(ids[i : i + BLOCK_IDS]) for i in range(0, len(ids), BLOCK_IDS)]
    offsets = np.zeros((len(blocks) + 1, 2), "<u8")
    for i, (words, escapes) in enumerate(blocks):
        offsets[i + 1] = offsets[i] + np.array([len(words), len(escapes)], "<u8")
    body = b"".join([
        offsets.tobytes(),
        *(w.astype("<u8").tobytes() for w, _ in blocks),
        *(e.astype("<u8").tobytes() for _, e in blocks),
    ])
    return HEAD.pack(MAGIC, zlib.crc32(body), len(ids), len(blocks), *map(int, offsets[-1])) + body


def decode_segment(data: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids of the blocks ``first`` to before ``last``; all without them."""
    magic, checksum, n, blocks, n_words, n_escapes = HEAD.unpack_from(data)
    if magic != MAGIC or zlib.crc32(memoryview(data)[HEAD.size :]) != checksum:
        raise ValueError("damaged Simple-8b segment")
    offsets = np.frombuffer(data, "<u8", 2 * (blocks + 1), HEAD.size).reshape(-1, 2).astype(np.int64)
    at = HEAD.size + 16 * (blocks + 1)
    words = np.frombuffer(data, "<u8", n_words, at)
    escapes = np.frombuffer(data, "<u8", n_escapes, at + 8 * n_words)
    last = blocks if last is None else last
    parts = [
        decode_block(words[offsets[i, 0] : offsets[i + 1, 0]], escapes[offsets[i, 1] : offsets[i + 1, 1]])
        for i in range(first, last)
    ]
    out = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    if (first, last) == (0, blocks) and len(out) != n:
        raise ValueError("Simple-8b segment of another length")
    return out
