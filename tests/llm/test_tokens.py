"""The transducer against the tokenizers library, and packing against its own invariants."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from playledger.llm import bpe, packing, tokens

POOL = "abcdefgABC  \n\t'stremld0123.,!<|>ÉéßÅå ΑΣσςİıñ漢字😀\x1c\x1d\x85\xa0 ​́̇ëﬁⅧ½²ǅᾈ가　\x00"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(bpe.TOKENIZER))


def test_ids_and_texts_as_the_library_gives_them(library):
    rnd, own = random.Random(1), bpe.tokenizer()
    texts = ["", " ", "<|startoftext|> a<|endoftext|>b <|x|>", "don't I'M we'LL 12345 a_b ___"]
    texts += ["".join(rnd.choice(POOL) for _ in range(rnd.randint(0, 30))) for _ in range(4000)]
    texts += ["".join(rnd.choice("aeinorst") for _ in range(n)) for n in (100, 199, 201, 5000)]
    for text in texts:
        wanted = library.encode(text, add_special_tokens=False).ids
        ids = own.encode(text)
        assert ids.tolist() == wanted
        assert own.decode(ids).decode() == library.decode(wanted, skip_special_tokens=False)


def test_the_transducer_holds_a_bounded_part_and_gives_the_same_ids(library):
    own, rnd = bpe.tokenizer(), random.Random(2)
    merges = bpe.Merges({}, 8)
    merges.pairs, merges.lookahead = own.merges.pairs, 400
    for alphabet in ("ab", "thein", "aeinorst", "xyz!?"):
        text = "".join(rnd.choice(alphabet) for _ in range(9000)).encode()
        symbols = [*(own.inner[b] for b in text[:-1]), own.last[text[-1]]]
        machine, out, most = bpe.Transducer(merges), [], 0
        for s in symbols:
            out += machine.feed([s])
            most = max(most, len(machine.held))
        assert [*out, *machine.end()] == own.merges.merge_long(symbols)[0]
        assert most <= 4 * 400 and len(out) > 100


def test_lookahead_follows_from_the_merges():
    assert bpe.lookahead([("a", "b")]) == 2
    assert bpe.lookahead([("a", "b"), ("c", "a"), ("d", "c")]) == 6
    assert bpe.lookahead([]) == 1


def test_the_text_decoder_is_incremental():
    own = bpe.tokenizer()
    ids = own.encode("Été 漢字 😀<|endoftext|> ok.").tolist()
    whole = own.text_decoder()
    text = whole.feed(ids) + whole.end()
    parts = own.text_decoder()
    assert "".join([*(parts.feed([i]) for i in ids), parts.end()]) == text
    assert text == "été 漢字 😀 <|endoftext|>ok . "


def test_digest_edges(spark, edges, nothing, library):
    rows = tokens.digests(edges).collect()
    texts = [r.text for r in edges.select("text").collect()]
    assert [r.n_tokens for r in rows] == [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]
    assert rows[0].ids_sha256 == hashlib.sha256(b"").hexdigest() == rows[0].decoded_sha256
    assert tokens.digests(nothing).count() == 0
    back = {r.doc_id: r.text for r in tokens.decode(tokens.encode(edges)).collect()}
    assert back[5] == "one two three four five six . " and back[2] == ""


def check_packed(rows, docs, library, capacity=2048):
    wanted = {i: np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t in docs.items()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for i, ids in wanted.items():
        at = 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    used = 0
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
        used += at
    return used / (capacity * len(sequences))


def test_packing(spark, library):
    rnd = random.Random(3)
    docs = {i: " ".join(rnd.choice(["the", "of", "a", "word"]) for _ in range(rnd.choice([0, 1, 50, 700, 1023, 2047, 5000]))) for i in range(400)}
    docs[400] = None
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(5)
    assert check_packed(packing.pack(df).collect(), docs, library) > 0.95


def test_packing_edges(spark, edges, nothing):
    rows = packing.pack(edges).collect()
    assert sum(r.length for r in rows if r.doc_id in (1, 2, 3)) == 3
    assert sum(r.start == 0 for r in rows) == edges.count()
    assert packing.pack(nothing).count() == 0
    with_ids = packing.pack(edges, with_ids=True).collect()
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in with_ids)


@pytest.mark.parametrize("seed", range(4))
def test_the_plan_holds_each_piece_once_near_the_bound(seed):
    rng = np.random.default_rng(seed)
    histogram = {int(c): int(n) for c, n in zip(rng.choice(np.arange(1, 129), 60, replace=False), rng.integers(1, 3000, 60))}
    patterns = packing.plan(histogram, 256)
    held = defaultdict(int)
    for times, items in patterns:
        assert sum(c * n for c, n in items.items()) <= 256
        for c, n in items.items():
            held[c] += times * n
    assert held == histogram
    bound = sum(c * n for c, n in histogram.items()) / 256
    assert sum(t for t, _ in patterns) <= 1.01 * bound + 60
