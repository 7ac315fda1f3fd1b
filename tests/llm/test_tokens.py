"""Token counts and pieces against the libraries, and exact round trips."""

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from samples import ODD_ROWS
from tokenizers import Tokenizer

from linkseek.llm import merges
from linkseek.llm.pieces import decode_pieces, encode_pieces, load_pieces
from linkseek.llm.token_counts import Counter, count_tokens, load_merges

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
STRANGE = [
    "", " ", "  a  b ", "<|endoftext|>", "a<|endoftext|>b <|endoftext|>", "it's we'll I'M 'S 've",
    "x" * 3000, "ab" * 700 + " " * 90, "\r\n\t a \x1c\x85 　z", "日本語の①ﬁ😀", "é́é", "１２³Ⅷ५",
    "<unk><s></s><0x0A>", "$$$###%%% a_b-c",
]


def library_counts(texts):
    tokenizer = Tokenizer.from_file(BPE)
    return [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_counts_are_the_library_s(texts):
    counter = Counter(load_merges(BPE))
    for given in (texts, STRANGE):
        assert counter.count(given) == library_counts(given)


def test_every_character_splits_as_in_the_library():
    characters = ["a" + chr(c) + "1" for c in [*range(1, 0xD800, 7), *range(0xE000, 0x110000, 61)]]
    assert Counter(load_merges(BPE)).count(characters) == library_counts(characters)


def test_proven_strings_encode_alone():
    whole = sorted(load_merges(BPE).whole)
    assert len(whole) > 40_000
    assert set(library_counts(whole[::50])) == {1}


def test_few_remembered_counts(texts, monkeypatch):
    monkeypatch.setattr("linkseek.llm.token_counts.REMEMBERED", 50)
    counter = Counter(load_merges(BPE))
    got = [n for i in range(0, len(texts), 7) for n in counter.count(texts[i : i + 7])]
    assert got == library_counts(texts)


def test_count_tokens(odd, no_rows):
    rows = count_tokens(odd, BPE, limit=100).collect()
    want = sorted((str(r[0]), len((r[1] or "").encode()), n) for r, n in zip(
        ODD_ROWS, library_counts([r[1] or "" for r in ODD_ROWS])))
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in rows) == want
    assert all(r.over_limit == (r.n_tokens > 100) for r in rows)
    assert count_tokens(no_rows, BPE).collect() == []


def encoded(pieces, texts, **how):
    ids, start = pieces.encode([x.encode() for x in texts], np.arange(len(texts)), **how)
    return [ids[a:b].tolist() for a, b in zip(start, start[1:])]


def test_without_dropout_pieces_are_the_library_s(texts):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    pieces = load_pieces(PIECES)
    for given in (texts, STRANGE):
        assert encoded(pieces, given) == [model.encode(x) for x in given]


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5, 1.0])
def test_decoding_gives_the_text_back(texts, dropout):
    pieces = load_pieces(PIECES)
    given = [x.encode() for x in [*texts, *STRANGE, "a▁b ▁"]]
    ids, start = pieces.encode(given, np.arange(len(given)), dropout, seed=3)
    assert pieces.decode(ids, start) == given


def test_dropout_follows_seed_and_key(texts):
    pieces = load_pieces(PIECES)
    once = encoded(pieces, texts, dropout=0.1, seed=1)
    assert once == encoded(pieces, texts, dropout=0.1, seed=1)
    other = encoded(pieces, texts, dropout=0.1, seed=2)
    assert sum(a != b for a, b in zip(once, other)) > 0.9 * len(texts)
    same_word = encoded(pieces, [" ".join(["unbelievable"] * 200)], dropout=0.3)[0]
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    segmentations = {tuple(x.split()) for x in " ".join(model.id_to_piece(same_word)).split("▁")}
    assert len(segmentations) > 5


def test_dropout_skips_its_share():
    """A merge of two symbols alone is skipped as often as it should be."""
    pieces = load_pieces(PIECES)
    words = [f"t{'o'}" for _ in range(4000)]
    n = [len(x) for x in encoded(pieces, words, dropout=0.25, draws=1 << 20)]
    whole = sum(x == 1 for x in n) / len(n)
    assert 0.4 < whole < 0.75  # two merges of a space and two letters, each skipped a quarter of the time


def test_long_words_merge_as_short_ones(monkeypatch):
    """The heap and the side-by-side agenda agree, skipped merges included."""
    pieces = load_pieces(PIECES)
    words = ["incomprehensibilities" * 2, "aaaaaaaabbbbaaaa", "Donaudampfschifffahrt"]
    for dropout in (0.0, 0.3):
        side = encoded(pieces, words, dropout=dropout)
        with monkeypatch.context() as m:
            m.setattr(merges, "SIDE_BY_SIDE", 0)
            m.setattr(merges, "_WIDTHS", ())
            assert encoded(pieces, words, dropout=dropout) == side


def merged_by_hand(symbols, pairs, skip):
    """Look through all neighbours for the lowest rank, leftmost first, and merge it unless it is skipped;
    a skipped pair waits until one of its sides changes."""
    row = list(enumerate(symbols))
    off = set()
    while True:
        ready = [(pairs[a[1], b[1]][0], a[0], i) for i, (a, b) in enumerate(zip(row, row[1:]))
                 if (a[1], b[1]) in pairs and (a, b) not in off]
        if not ready:
            return [x for _, x in row]
        _, place, i = min(ready)
        into = pairs[row[i][1], row[i + 1][1]][1]
        if skip(place, into):
            off.add((row[i], row[i + 1]))
        else:
            row[i : i + 2] = [(place, into)]


@pytest.mark.parametrize("dropout", [0.0, 0.2, 0.6, 1.0])
def test_merges_against_brute_force(dropout):
    """Random merge tables and words of all widths, with merges skipped by a hash."""
    rng = np.random.default_rng(int(dropout * 10))
    for _ in range(12):
        pairs, known = {}, list(range(4))
        for into in range(4, 40):
            a, b = (known[i] for i in rng.integers(0, len(known), 2))
            if (a, b) not in pairs:
                pairs[a, b] = (int(rng.integers(0, 20)), into)
                known.append(into)
        words = [rng.integers(0, 4, n) for n in (1, 2, 3, 5, 9, 14, 20, 33, 48, 49, 70)]
        start = np.concatenate([[0], np.cumsum([len(w) for w in words])])

        def skipped(word, place, into):
            return (hash((word, place, into)) & 1023) / 1024 < dropout

        skip = lambda w, p, i: np.array([skipped(*map(int, x)) for x in zip(w, p, i)], bool)
        got, at = merges.merge_words(np.concatenate(words), start, merges.PairTable(pairs), skip if dropout else None)
        for n, word in enumerate(words):
            want = merged_by_hand(word.tolist(), pairs, lambda p, i, n=n: skipped(n, p, i))
            assert got[at[n] : at[n + 1]].tolist() == want


def test_encode_and_decode(odd, no_rows):
    rows = encode_pieces(odd, PIECES)
    got = rows.collect()
    assert len(got) == len(ODD_ROWS) and all(r.lossless and r.n_pieces == len(r.ids) for r in got)
    texts = sorted((str(r.doc_id), r.text) for r in decode_pieces(rows, PIECES).collect())
    assert texts == sorted((str(r[0]), r[1] or "") for r in ODD_ROWS)
    assert encode_pieces(no_rows, PIECES).collect() == []
