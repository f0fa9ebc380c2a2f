"""Token counts by compiled finite-state transducers.

Two machines do the work.  The first cuts text into pretokens (``pretokens``): its
chunk state maps compose in a parallel prefix scan, so a long text is many short
independent runs.  The second emits token counts: reading a pretoken ends in a state
whose annotation is the number of tokens of that pretoken under the vocabulary's
merges.  Its states are compiled when a pretoken is first met, for all new ones of a
batch together, and are kept in a bounded lexicon.  A text's count is the sum of the
annotations on its way; special strings emit one token each and restart the first machine.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, functions as F

from ringlake.llm.pretokens import SPECIAL, Lexicon, Splitter, character_classes, install_classes, runs_of, split_texts

NONE = np.iinfo(np.int32).max


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = [""] * 256, 0
    for byte in range(256):
        letters[byte] = chr(byte) if byte in plain else chr(256 + extra)
        extra += byte not in plain
    return letters


class MergeTable:
    """The merges of a byte-level vocabulary as sorted arrays: pair of ids to rank and merged id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            layout = json.load(file)
        if layout["normalizer"] is not None or layout["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError("only plain byte-level vocabularies can be compiled")
        vocab = layout["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in layout["model"]["merges"]]
        keys = np.array([vocab[a] << 20 | vocab[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        self.byte_ids = np.array([vocab[c] for c in byte_letters()], dtype=np.int64)
        self.special = [t["content"] for t in layout["added_tokens"]]

    def counts(self, pretokens: list[bytes]) -> np.ndarray:
        """Tokens of each pretoken; all of them take their next merge in the same step."""
        out = np.zeros(len(pretokens), dtype=np.int64)
        sizes = np.array([len(p) for p in pretokens], dtype=np.int64)
        ids = self.byte_ids[np.frombuffer(b"".join(pretokens), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(pretokens)), sizes)
        while len(ids):
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            rank = np.full(len(ids), NONE, dtype=np.int32)
            inner = np.flatnonzero(owner[:-1] == owner[1:])
            keys = ids[inner] << 20 | ids[inner + 1]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            rank[inner] = np.where(self.keys[at] == keys, self.ranks[at], NONE)
            lengths = np.diff(np.append(first, len(ids)))
            best = np.minimum.reduceat(rank, first)
            done = best == NONE
            out[owner[first[done]]] = lengths[done]
            going = np.repeat(~done, lengths)
            chosen = (rank == np.repeat(best, lengths)) & going
            # Of a run of equal pairs that overlap, every other one is merged.
            place = np.arange(len(ids))
            chosen &= (place - np.maximum.accumulate(np.where(chosen, -1, place))) % 2 == 1
            ids[chosen] = self.merged[rank[chosen]]
            gone = np.zeros(len(ids), dtype=bool)
            gone[1:] = chosen[:-1]
            keep = going & ~gone
            ids, owner = ids[keep], owner[keep]
        return out


class CountingTransducer:
    def __init__(self, path: str):
        self.merges = MergeTable(path)
        self.splitter = Splitter(spaces=True)
        self.forget()

    def forget(self) -> None:
        self.lexicon = Lexicon()
        self.emits: list[np.ndarray] = [np.zeros(0, dtype=np.int64)]
        self.n_rows = 0

    def counts(self, texts: list[str]) -> np.ndarray:
        runs = [self._run(run) for run in runs_of(texts)]
        return np.concatenate(runs) if runs else np.zeros(0, dtype=np.int64)

    def _run(self, texts: list[str]) -> np.ndarray:
        for word in self.merges.special:
            texts = [t.replace(word, SPECIAL) if word in t else t for t in texts]
        cut = split_texts(texts, self.splitter)
        rows = self._states(cut)
        emitted = np.append(0, np.cumsum(np.concatenate(self.emits)[rows]))
        totals = np.diff(emitted[np.append(cut.firsts, len(rows))])
        return totals + np.array([t.count(SPECIAL) for t in texts], dtype=np.int64)

    def _states(self, cut) -> np.ndarray:
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
        counts = self.merges.counts([cut.text_of(i).encode() for i in new[which]])
        self.lexicon.add(fresh, np.arange(self.n_rows, self.n_rows + len(fresh), dtype=np.int32))
        self.emits = [np.concatenate([*self.emits, counts])]
        self.n_rows += len(fresh)
        return self.lexicon.find(cut.hashes)


@lru_cache(maxsize=2)
def transducer(path: str) -> CountingTransducer:
    """One per worker process and vocabulary."""
    return CountingTransducer(path)


def count_tokens(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", limit: int = 512) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), a row for each row of ``docs``.

    ``path`` is a byte-level vocabulary file that every executor can open.  Null texts
    count as empty and have no tokens; repeated rows are counted each; an
    empty table gives an empty table.  Extra columns are not read.  Row-wise: nothing is shuffled,
    and a worker holds one batch of texts and the lexicon.
    """
    classes = docs.sparkSession.sparkContext.broadcast(character_classes())
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        install_classes(classes.value)
        machine = transducer(path)
        for batch in batches:
            texts = batch.column("text")
            sizes = pa.compute.binary_length(texts).cast(pa.int64())
            counts = pa.array(machine.counts(texts.to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), sizes, counts], ["doc_id", "n_bytes", "n_tokens"]
            )

    schema = f"doc_id {id_type}, n_bytes long, n_tokens long"
    return rows.mapInArrow(counted, schema).withColumn("over_limit", F.col("n_tokens") > limit)
