import zlib

import numpy as np
import public_tokenizers
import pytest
from data import documents, rows_of, sentence
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from ringlake.llm import binary, encoding, packing, pretokens, token_counts

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "  \n\n x", "it's we'll 'S 's's'", "a\t\tb   c", "<|endoftext|> x<|endoftext|>", "<|startoftext|>a", "é é İI ſK",
    "123 4a5b ٣Ⅳ", "漢字かな交じり🙂🙂", "'' '' '''re", "\r\n'd", "x" * 5000, " " * 3000 + "y", "ᾳ ﬁ ǅ ß", "!!!'s ...'ll ''t",
]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_ids_are_the_librarys(path):
    library, coder = Tokenizer.from_file(path), encoding.Encoder(path)
    for texts in (ODD, ODD[::-1], [sentence(i, 50) for i in range(20)]):
        ids, ends = coder.encode(texts)
        got = [part.tolist() for part in np.split(ids, ends)[:-1]]
        assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


MACHINE = token_counts.CountingTransducer(BYTE)
LIBRARY = Tokenizer.from_file(BYTE)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list(" \n\t'srelvtmdLa1é漢🙂.!<|>́ ")), max_size=40), max_size=4))
def test_counts_are_the_librarys(texts):
    assert MACHINE.counts(texts).tolist() == [len(e.ids) for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def test_scan_equals_a_plain_run():
    following, output = pretokens.Splitter(spaces=True).tables()
    symbols = np.random.default_rng(1).integers(0, 9, 5000).astype(np.uint8)
    state, plain = 0, []
    for s in symbols:
        plain.append(output[s << 3 | state])
        state = following[s << 3 | state]
    for chunk in (1, 7, 256, 10_000):
        assert pretokens.run_transducer(symbols, following, output, chunk).tolist() == plain


def test_full_lexicon_starts_anew():
    coder = encoding.Encoder(BYTE)
    coder.lexicon = pretokens.Lexicon(bits=4)
    texts = [sentence(i, 30) for i in range(5)]
    got = [coder.encode([t])[0].tolist() for t in texts]
    assert got == [e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def test_count_rows(docs, no_docs):
    got = rows_of(token_counts.count_tokens(docs, BYTE), "doc_id", "n_bytes", "n_tokens", "over_limit")
    wanted = []
    for r in docs.collect():
        n = len(LIBRARY.encode(r.text or "", add_special_tokens=False).ids)
        wanted.append((r.doc_id, len((r.text or "").encode()), n, n > 512))
    assert got == sorted(wanted, key=repr)
    assert token_counts.count_tokens(no_docs, BYTE).count() == 0


@pytest.mark.parametrize("n", [1, 5, 1024, 1025, 300_000])
def test_blocks_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n), 50_000).astype(np.int64)
    segment = binary.encode_segment(ids, [1], [n])
    assert (binary.decode_segment(segment) == ids).all()
    segment["blocks"][0]["crc32"] ^= 1
    with pytest.raises(ValueError):
        binary.decode_segment(segment)


def test_decoding_starts_at_checkpoints():
    ids = np.arange(binary.LANES * binary.BLOCK_STEPS) % 977
    segment = binary.encode_segment(ids, [1], [len(ids)])
    block = segment["blocks"][0]
    model = binary.Model.of(ids)
    at = block["checkpoints"][0]
    part = binary.decode_steps(len(ids), at["step"], binary.BLOCK_STEPS, at["word"], at["states"], np.frombuffer(block["words"], "<u4"), model, model.slots())
    assert (model.symbols[part] == ids[at["step"] * binary.LANES :]).all()


def test_frequencies_add_up():
    for counts in ([1], [10**9, 1], [1] * 5000, [7] * 50_000, [10**9] + [1] * 60_000):
        scaled = binary.frequencies(np.array(counts, dtype=np.int64))
        assert scaled.sum() == 1 << binary.SCALE and scaled.min() >= 1


def test_files(spark, docs, no_docs, tmp_path):
    binary.write_ids(docs, BYTE, str(tmp_path / "ids"))
    got = binary.read_ids(spark, str(tmp_path / "ids")).orderBy("start").collect()
    keyed = sorted(((-1 if r.doc_id is None else r.doc_id), r.text or "") for r in docs.collect())
    assert [(-1 if r.doc_id is None else r.doc_id) for r in got] == [k for k, _ in keyed]
    start, texts = 0, {}
    for k, t in keyed:
        texts.setdefault(k, []).append(LIBRARY.encode(t, add_special_tokens=False).ids + [0])
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.start == start and ids in texts[-1 if r.doc_id is None else r.doc_id]
        start += len(ids)
    binary.write_ids(no_docs, BYTE, str(tmp_path / "none"))
    assert binary.read_ids(spark, str(tmp_path / "none")).count() == 0


def test_packing(spark, docs, no_docs):
    library = Tokenizer.from_file(WORD)
    packed = packing.pack_documents(docs, WORD, capacity=500, keep_ids=True).collect()
    wanted = []
    for r in docs.collect():
        ids = np.array(library.encode(r.text or "", add_special_tokens=False).ids + [1], dtype="<u4")
        wanted += [(r.doc_id, a // 500, a, len(ids[a : a + 500]), zlib.crc32(ids[a : a + 500].tobytes())) for a in range(0, len(ids), 500)]
    assert sorted((tuple(r)[:5] for r in packed), key=repr) == sorted(wanted, key=repr)
    by_sequence = {}
    for r in packed:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 500
    assert len(by_sequence) <= -(-sum(w[3] for w in wanted) // 500) + 1
    assert packing.pack_documents(no_docs, WORD).count() == 0


@pytest.mark.parametrize("lengths, demand, best", [([6, 4, 3, 7], [5, 5, 10, 10], 15), ([10], [4], 4), ([5, 6], [3, 3], 5), ([1], [100], 10)])
def test_patterns(lengths, demand, best):
    order = np.argsort(lengths)
    lengths, demand = np.array(lengths)[order], np.array(demand)[order]
    patterns = packing.packed_patterns(lengths, demand, 10)
    held = dict.fromkeys(lengths.tolist(), 0)
    for p in patterns:
        assert (p.lengths * p.copies).sum() <= 10
        for length, copies in zip(p.lengths.tolist(), p.copies.tolist()):
            held[length] += p.bins * copies
    assert list(held.values()) == demand.tolist() and sum(p.bins for p in patterns) <= best


def test_knapsack_against_brute_force():
    import itertools

    lengths, prices = np.array([3, 4, 5]), np.array([2.0, 3.0, 3.9])
    which, copies = packing.dearest_pattern(lengths, prices, 11)
    best = max(sum(c * p for c, p in zip(cs, prices)) for cs in itertools.product(range(4), repeat=3) if sum(c * n for c, n in zip(cs, lengths)) <= 11)
    assert abs(float((prices[which] * copies).sum()) - best) < 1e-9


def test_program_places_pieces_where_greed_falls_short():
    # 510 + 260 + 230 and 2 * 270 + 2 * 230 are full; longest first takes 510 + 270 and wastes the rest.
    lengths, demand = np.array([230, 260, 270, 510]), np.array([2400, 1200, 1200, 1200])
    chosen, bound = packing.priced_patterns(lengths, demand.astype(float), 1000)
    assert bound <= 1800 + 1e-6 and sum(c[0] for c in chosen) <= (1 + packing.GAP) * bound
    patterns = packing.packed_patterns(lengths, demand, 1000)
    held = dict.fromkeys(lengths.tolist(), 0)
    for p in patterns:
        assert (p.lengths * p.copies).sum() <= 1000
        for length, copies in zip(p.lengths.tolist(), p.copies.tolist()):
            held[length] += p.bins * copies
    assert list(held.values()) == demand.tolist()
    by_program = sum(p.bins * int(p.copies.sum()) for p in patterns if p.by_program)
    assert by_program >= 0.9 * demand.sum() and sum(p.bins for p in patterns) <= 1.02 * 1800
    assert sum(p.bins for p in packing.greedy_patterns(lengths, demand, 1000)) == 2200


def test_bounded_knapsack():
    which, copies = packing.dearest_pattern(np.array([3, 4, 5]), np.array([2.0, 3.0, 3.9]), 20, np.array([4, 1, 1]))
    assert dict(zip(which.tolist(), copies.tolist())) == {0: 3, 1: 1, 2: 1}


@pytest.mark.parametrize("rounds", [0, 1, 50])
def test_the_program_ends_in_time(monkeypatch, rounds):
    """900 lengths that greed packs badly: with a few rounds only, every piece still has its place."""
    lengths, demand = np.arange(1100, 2000), np.full(900, 20)
    cells = int(np.ceil(np.log2(np.minimum(4096 // lengths, 20) + 1)).sum()) * 4097
    monkeypatch.setattr(packing, "MOST_CELLS", rounds * cells)
    chosen, bound = packing.priced_patterns(lengths, demand.astype(float), 4096)
    assert bound <= (lengths * demand).sum() / 2048
    patterns = packing.packed_patterns(lengths, demand)
    held = dict.fromkeys(lengths.tolist(), 0)
    for p in patterns:
        assert (p.lengths * p.copies).sum() <= 4096
        for length, n in zip(p.lengths.tolist(), p.copies.tolist(), strict=True):
            held[length] += n * p.bins
    assert set(held.values()) == {20}


def test_the_program_packs_where_greed_would_do():
    """Many short pieces, where greed is near the sum of lengths: the patterns are still the program's, and as few."""
    rng = np.random.default_rng(7)
    lengths, demand = np.unique(rng.integers(20, 1000, 900), return_counts=True)
    patterns = packing.packed_patterns(lengths, demand, 1000)
    held = dict.fromkeys(lengths.tolist(), 0)
    for p in patterns:
        assert (p.lengths * p.copies).sum() <= 1000
        for length, copies in zip(p.lengths.tolist(), p.copies.tolist(), strict=True):
            held[length] += p.bins * copies
    assert list(held.values()) == demand.tolist() and all(p.by_program for p in patterns)
    assert sum(p.bins for p in patterns) <= sum(p.bins for p in packing.greedy_patterns(lengths, demand, 1000))


def test_knapsack_for_each_longest_piece():
    import itertools

    lengths, prices, most = np.array([3, 4, 5, 6]), np.array([2.0, 3.0, 3.9, 4.0]), np.array([2, 1, 1, 2])
    table = packing.Knapsack(lengths, prices, 13, most)
    for i in range(4):
        which, copies = table.pattern(i)
        held = dict(zip(which.tolist(), copies.tolist()))
        fits = [c for c in itertools.product(*[range(m + 1) for m in most[: i + 1]]) if c[i] and np.dot(c, lengths[: i + 1]) <= 13]
        assert held[i] and max(held) == i and all(n <= most[k] for k, n in held.items())
        assert np.dot(prices[which], copies) == pytest.approx(max(np.dot(c, prices[: i + 1]) for c in fits)) == table.values[i]
