"""Ids of many texts at once under a byte-level BPE file of the tokenizers library.

In the splitting pattern of such files, a single blank or line break between two other characters
is always a border, and what lies between two borders is encoded on its own. A block of texts is
therefore cut into words with numpy, each distinct word of the block is encoded once, and the ids
are gathered back in order. Texts with any other white space are encoded whole. The distinct words
of a block go through the same merges as the file's, by the ``tiktoken`` library, whose ranks are
read from the file; a file whose merges are not in the order of their ids is encoded by the
``tokenizers`` library throughout.
"""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
import pyarrow as pa

from .textbytes import SpanHasher, blocks, rows_of, text_buffer, words

BLOCK_BYTES = 8 << 20

# Fixed value: the splitting pattern of byte-level BPE files.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_SEPARATES = np.zeros(256, bool)
_SEPARATES[[0x20, 0x0A]] = True
_BETWEEN = ~_SEPARATES
_OTHER_SPACE = np.zeros(256, bool)  # ASCII white space but blank and line break, and separators near it
_OTHER_SPACE[[0x09, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F]] = True
_LEADS = np.zeros(256, bool)  # first bytes of white space beyond ASCII
_LEADS[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def _alphabet() -> dict[str, int]:
    """Byte of each character of the byte-level alphabet: printable bytes stand for themselves, the
    others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Encoder:
    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, added = spec["model"], {t["content"] for t in spec.get("added_tokens", [])}
        vocab = {t: i for t, i in model["vocab"].items() if t not in added}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
        pre = spec.get("pre_tokenizer") or {}
        ordered = [vocab.get(a + b, -1) for a, b in pairs]
        self.fast = (
            spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
            and not pre.get("add_prefix_space") and bool(ordered) and min(ordered) >= 0
            and all(a < b for a, b in zip(ordered, ordered[1:], strict=False))
        )
        self.kind = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        if self.fast:
            spelled = _alphabet()
            ranks = {bytes(spelled[c] for c in t): i for t, i in vocab.items()}
            self.merges = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.size = np.zeros(max(vocab.values()) + 1, np.int64)  # bytes of each id
            for t, i in ranks.items():
                self.size[i] = len(t)
        self.line_break = self.text("\n")

    def text(self, text: str) -> np.ndarray:
        """Ids of one whole text."""
        if not text:
            return np.zeros(0, self.kind)
        if self.fast:
            return np.array(self.merges.encode_ordinary(text), self.kind)
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind)

    def _distinct(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, lead: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, begin, count) of distinct words, each encoded behind the blank or line break that
        stands before it; nothing (lead 1) counts as a line break whose own id is left out."""
        if not len(starts):
            return np.zeros(0, self.kind), np.zeros(0, np.int64), np.zeros(0, np.int64)
        ends = np.cumsum(sizes + 1)
        at = np.arange(ends[-1]) + np.repeat(starts - 1 - (ends - sizes - 1), sizes + 1)
        joined = data[np.maximum(at, 0)]
        joined[ends - sizes - 1] = np.where(lead == 0, 0x20, 0x0A)
        ids = self.text(joined.tobytes().decode("utf-8"))
        stop = np.searchsorted(np.cumsum(self.size[ids]), ends, "left") + 1  # ids up to the end of each word
        begin = np.concatenate([[0], stop[:-1]])
        alone = (lead == 1).astype(np.int64)
        return ids, begin + alone, stop - begin - alone

    def _block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, counts per row) of a block of texts."""
        n = len(offsets) - 1
        plain = self._plain(data, offsets) if self.fast else np.zeros(n, bool)
        starts, ends, first = words(data, offsets, _BETWEEN)
        row = rows_of(first)
        if not plain.all():
            use = plain[row]
            starts, ends, row = starts[use], ends[use], row[use]
        # what stands before a word: a blank (0), nothing (1) or a line break (2)
        lead = (data[np.maximum(starts - 1, 0)] == 0x0A) * 2
        lead[starts == offsets[row]] = 1
        key = SpanHasher(data)(starts, ends) if len(starts) else np.zeros(0, np.uint64)
        which, distinct = pd.factorize((key & ~np.uint64(3)) | lead.astype(np.uint64))
        one = np.empty(len(distinct), np.int64)
        one[which[::-1]] = np.arange(len(which) - 1, -1, -1)  # the first place of each
        pool, begin, counts = self._distinct(data, starts[one], (ends - starts)[one], lead[one])
        odd = np.flatnonzero(~plain)
        if len(odd):  # other rows are one item each
            whole = [self.text(data[offsets[r] : offsets[r + 1]].tobytes().decode("utf-8", "replace")) for r in odd]
            sizes = np.array([len(x) for x in whole], np.int64)
            begin = np.concatenate([begin, len(pool) + np.cumsum(sizes) - sizes])
            counts = np.concatenate([counts, sizes])
            pool = np.concatenate([pool, *whole])
            item = np.concatenate([which, len(distinct) + np.arange(len(odd))])
            row = np.concatenate([row, odd])
            order = np.argsort(row, kind="stable")
            which, row = item[order], row[order]
        size = counts[which]
        stop = np.cumsum(size)
        take = np.repeat(begin[which] - (stop - size), size)
        take += np.arange(len(take))
        return pool[take], np.bincount(row, size, n).astype(np.int64)

    def _plain(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Rows whose white space is single blanks and line breaks between other characters."""
        out = np.ones(len(offsets) - 1, bool)
        if not len(data):
            return out
        apart = _SEPARATES[data]
        edges = np.concatenate([offsets[:-1], offsets[1:] - 1])
        edges = edges[(edges >= 0) & (edges < len(data))]
        at = np.flatnonzero(_LEADS[data[:-1]])
        two = data[at + 1]
        three = data[np.minimum(at + 2, len(data) - 1)]
        b = data[at]
        wide = (
            ((b == 0xC2) & ((two == 0x85) | (two == 0xA0))) | ((b == 0xE1) & (two == 0x9A) & (three == 0x80))
            | ((b == 0xE2) & (two == 0x80) & ((three <= 0x8A) | (three == 0xA8) | (three == 0xA9) | (three == 0xAF)))
            | ((b == 0xE2) & (two == 0x81) & (three == 0x9F)) | ((b == 0xE3) & (two == 0x80) & (three == 0x80))
        )
        wrong = np.concatenate([
            np.flatnonzero(_OTHER_SPACE[data]), np.flatnonzero(apart[1:] & apart[:-1]) + 1, edges[apart[edges]], at[wide],
        ])
        out[np.searchsorted(offsets, wrong, "right") - 1] = False
        return out

    def column(self, texts: pa.Array):
        """(first row, ids, counts per row) of each block of a column; nulls are empty texts."""
        data, offs = text_buffer(texts)
        for a, b in blocks(offs, BLOCK_BYTES):
            ids, counts = self._block(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
            yield a, ids, counts
