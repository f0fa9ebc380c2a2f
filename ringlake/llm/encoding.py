"""Token ids of whole texts, exactly as the tokenizers library gives them.

The library is asked for every distinct pretoken once per worker; ids of whole texts
are then put together from a bounded lexicon.  Texts for which the pretoken cut cannot
be foreseen (not in the vocabulary's normal form) go to the library whole.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import numpy as np

from ringlake.llm.pretokens import SPECIAL, Lexicon, Splitter, runs_of, split_texts

DOTTED_CAPITAL_I = "İ"  # its lower case is a letter and a mark


class Encoder:
    """``encode(texts)`` gives the flat ids and the end of each text in them."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            layout = json.load(file)
        self.normalized = layout["normalizer"] is not None
        self.splitter = Splitter(spaces=not self.normalized)
        self.special = {t["content"]: t["id"] for t in layout["added_tokens"]}
        self.forget()

    def forget(self) -> None:
        self.lexicon = Lexicon()
        self.flat = np.zeros(1 << 16, dtype=np.int32)
        self.starts = np.zeros(1 << 16, dtype=np.int64)
        self.sizes = np.zeros(1 << 16, dtype=np.int32)
        self.n_rows = self.n_flat = 0

    def _foreseen(self, text: str) -> bool:
        return not self.normalized or (unicodedata.is_normalized("NFC", text) and DOTTED_CAPITAL_I not in text)

    def ask(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        pieces, sizes = [], []
        for run in runs_of(texts):
            ids, counts = self._encode_run(run)
            pieces.append(ids)
            sizes.append(counts)
        if not pieces:
            return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
        return np.concatenate(pieces), np.cumsum(np.concatenate(sizes))

    def _encode_run(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        odd = {i for i, t in enumerate(texts) if not self._foreseen(t) or any(s in t for s in self.special)}
        cut = split_texts(["" if i in odd else t for i, t in enumerate(texts)], self.splitter)
        rows = self._rows(cut)
        sizes = self.sizes[rows].astype(np.int64)
        total = int(sizes.sum())
        before = np.cumsum(sizes) - sizes
        ids = self.flat[np.arange(total) + np.repeat(self.starts[rows] - before, sizes)]
        ends = np.append(before, total)
        bounds = ends[np.append(cut.firsts, len(rows))]
        counts = np.diff(bounds)
        if odd:
            parts = []
            for i, t in enumerate(texts):
                part = np.array(self.ask([t])[0], dtype=np.int32) if i in odd else ids[bounds[i] : bounds[i + 1]]
                parts.append(part)
                counts[i] = len(part)
            ids = np.concatenate(parts)
        return ids, counts

    def _rows(self, cut) -> np.ndarray:
        rows = self.lexicon.find(cut.hashes)
        new = np.flatnonzero(rows < 0)
        if not len(new):
            return rows
        fresh, which = np.unique(cut.hashes[new], return_index=True)
        if not self.lexicon.has_room(len(fresh)):
            self.forget()
            new = np.arange(len(cut.hashes))
            fresh, which = np.unique(cut.hashes, return_index=True)
            while not self.lexicon.has_room(len(fresh)):
                self.lexicon = Lexicon(self.lexicon.bits + 1)
        encoded = self.ask([cut.text_of(i) for i in new[which]])
        self.lexicon.add(fresh, self._keep(encoded))
        return self.lexicon.find(cut.hashes)

    def _keep(self, encoded: list[list[int]]) -> np.ndarray:
        sizes = np.array([len(e) for e in encoded], dtype=np.int32)
        flat = np.array([i for e in encoded for i in e], dtype=np.int32)
        rows = np.arange(self.n_rows, self.n_rows + len(sizes), dtype=np.int32)
        self.flat = _grown(self.flat, self.n_flat + len(flat))
        self.starts = _grown(self.starts, self.n_rows + len(sizes))
        self.sizes = _grown(self.sizes, self.n_rows + len(sizes))
        self.flat[self.n_flat : self.n_flat + len(flat)] = flat
        self.starts[rows] = self.n_flat + np.cumsum(sizes) - sizes
        self.sizes[rows] = sizes
        self.n_rows += len(sizes)
        self.n_flat += len(flat)
        return rows


def _grown(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    out = np.zeros(max(size, 2 * len(array)), dtype=array.dtype)
    out[: len(array)] = array
    return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per worker process and vocabulary."""
    return Encoder(path)
