"""Byte-level BPE over whole batches of documents.

Texts are cut at places where the public pre-tokenizer pattern always starts
a new token: before a single space between two characters that are not white
space. Each distinct stretch is encoded once per batch, all together, and its
ids are copied to every place where it stands, so the ids equal those of
encoding each whole text by itself.
"""

from __future__ import annotations

import base64
from pathlib import Path

import numpy as np
import public_tokenizers

from tapehouse.llm import textarrays as ta

BYTE_BPE = "byte_bpe_50k.tiktoken"
#: The added tokens of the vocabulary's tokenizer file; none holds white space.
ADDED = {"<|endoftext|>": 50256}
#: Bytes of text that a task encodes together; only memory depends on it.
ENCODED_AT_ONCE = 1 << 20


class Bpe:
    """Encoder over a public rank file; ``ADDED`` strings in a text become their own ids."""

    def __init__(self, path: str | None = None):
        import tiktoken

        raw = Path(path or public_tokenizers.path(BYTE_BPE)).read_bytes()
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in raw.splitlines() if line)}
        self.encoding = tiktoken.Encoding(
            "bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=ADDED
        )
        self.n_bytes = np.zeros(max(*ranks.values(), *ADDED.values()) + 1, np.int32)
        self.added = [x.encode() for x in ADDED]
        for token, rank in [*ranks.items(), *((x.encode(), i) for x, i in ADDED.items())]:
            self.n_bytes[rank] = len(token)

    def _one(self, raw: np.ndarray) -> np.ndarray:
        raw = raw.tobytes()
        text = raw.decode("utf-8")
        if any(x in raw for x in self.added):
            return np.array(self.encoding.encode(text, allowed_special="all"), np.uint32)
        return np.array(self.encoding.encode_ordinary(text), np.uint32)

    def encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents and each document's range in them."""
        n = len(data)
        cut = np.zeros(n, bool)
        if n > 2:
            plain = (data > 0x20) & (data < 0x7F)  # an ASCII character that is not white space
            two, three = (data >= 0xC3) & (data <= 0xDF), (data >= 0xE4) & (data <= 0xEF)
            begins = plain | two | (data >= 0xE4)  # first byte of a character that is not white space
            tail = data >= 0x80
            ends = plain.copy()  # last byte of such a character
            ends[1:] |= tail[1:] & two[:-1]
            ends[2:] |= tail[2:] & tail[1:-1] & three[:-2]
            cut[1:-1] = (data[1:-1] == 0x20) & ends[:-2] & begins[2:]
            edges = offs[1:-1]
            for near in (edges, edges - 1):  # neighbours in other documents do not count
                cut[near[(near >= 0) & (near < n)]] = False
        full = offs[:-1] < offs[1:]
        first = offs[:-1][full]
        regular = cut.copy()
        cut[first] = True
        starts = np.flatnonzero(cut)
        stops = np.append(starts[1:], n) if len(starts) else starts
        closed = np.zeros(n + 1, bool)
        closed[:n] = regular
        clean = regular[starts] & closed[stops]
        h = ta.span_hash(data, starts, stops)
        counts = np.zeros(len(starts), np.int64)
        base = np.zeros(len(starts), np.int64)
        parts: list[np.ndarray] = []
        if clean.any():
            at = np.flatnonzero(clean)
            _, where, inverse = np.unique(h[at], return_index=True, return_inverse=True)
            a, b = starts[at[where]], stops[at[where]]
            size = b - a
            text = data[np.repeat(a - np.cumsum(size) + size, size) + np.arange(size.sum())]
            tokens = self._one(text)
            done = np.concatenate(([0], np.cumsum(self.n_bytes[tokens])))
            edge = np.searchsorted(done, np.concatenate(([0], np.cumsum(size))))
            counts[at], base[at] = np.diff(edge)[inverse], edge[:-1][inverse]
            parts.append(tokens)
        filled = sum(map(len, parts))
        for i in np.flatnonzero(~clean).tolist():
            tokens = self._one(data[starts[i] : stops[i]])
            counts[i], base[i] = len(tokens), filled
            filled += len(tokens)
            parts.append(tokens)
        pool = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        total = np.concatenate(([0], np.cumsum(counts)))
        ids = pool[np.repeat(base - total[:-1], counts) + np.arange(total[-1])]
        return ids, total[np.searchsorted(starts, offs)]
