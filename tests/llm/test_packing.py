import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from wearcast.llm import packing as P


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(P.default_tokenizer())


def hard_texts():
    rng = random.Random(6)
    bits = ["word", "Word's", "it'stuff", "'ll", "don't.", "<|endoftext|>", "<|ENDOFTEXT|>", "a<|startoftext|>b", "<", "é", "É",
            "é", "×", "÷", "—", "naïve—text", "123", "4.56", "***", "!!", "́", "≠", "İstanbul", "ΟΔΟΣ",
            " ", " ", "x y", "😀", "日本語", "\x00", "\x1c", "\x7f", "a_b", "a`b", "[x]", "{y}", "~", "ﬁ", "x" * 300]
    for _ in range(400):
        yield "".join(rng.choice(bits) + rng.choice(["", "", " ", "\n", "\t\r", "\x0b", "  "]) for _ in range(rng.randint(0, 14)))


def test_pieces_of_text_give_the_ids_of_whole_texts(tokenizer):
    texts = list(hard_texts()) + [None, "", " "]
    e = P.Encoder(P.default_tokenizer())
    for part in (texts[:150], texts[150:], texts):
        ids, at = e.encode(*P.tokens_of(pa.array(part, pa.string())))
        for i, t in enumerate(part):
            want = tokenizer.encode(t or "", add_special_tokens=False).ids
            assert ids[at[i]:at[i + 1]].tolist() == want, repr(t)


def test_curve_visits_neighbours():
    side = 8
    grid = np.stack(np.meshgrid(*[np.arange(side)] * 3, indexing="ij"), -1).reshape(-1, 3)
    place = P.hilbert(grid, bits=3)
    assert sorted(place.tolist()) == list(range(side**3))
    walk = grid[np.argsort(place)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("cell_bytes", [2000, 1 << 24])
def test_pieces_cover_every_id_once(docs_of, nasty, tokenizer, cell_bytes):
    rows = nasty + [(100 + i, t * 20) for i, t in enumerate(hard_texts())]
    got = P.pack_documents(docs_of(rows), P.default_tokenizer(), cell_bytes=cell_bytes).collect()
    want = sorted((str(i), tuple(tokenizer.encode(t or "", add_special_tokens=False).ids) + (1,)) for i, t in rows)
    stream, spans = {}, {}
    for r in got:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        spans.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        stream.setdefault(r["sequence_id"] * P.SEQUENCE + r["offset"], r)
    for q, parts in spans.items():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at == P.SEQUENCE or q == max(spans)
    assert sorted(spans) == list(range(len(spans)))
    docs, cur = [], []
    for k in sorted(stream):  # documents lie whole along the stream
        r = stream[k]
        assert r["start"] == sum(len(x) for x in cur)
        cur.append(np.frombuffer(r["ids"], "<u4").tolist())
        if r["start"] + r["length"] == r["doc_tokens"]:
            docs.append((str(r["doc_id"]), tuple(x for p in cur for x in p)))
            cur = []
    assert sorted(docs) == want and not cur


def test_empty_table(docs_of):
    assert P.pack_documents(docs_of([(1, "x")]).limit(0), P.default_tokenizer()).count() == 0


def test_rearranged_words_keep_apart():
    """Words of the same bytes in Thue-Morse order cancel out in polynomial
    hashes modulo a power of two; they must keep their own hashes and ids."""
    import pyarrow as pa

    bits = np.array([bin(i).count("1") & 1 for i in range(2048)])
    pairs = []
    for a, b in ("ab", "xy"):
        for n in (2, 64, 1024, 2048):
            pairs += ["".join(a if x else b for x in bits[:n]), "".join(b if x else a for x in bits[:n])]
    words, buf = P.tokens_of(pa.array(pairs))
    assert len(set(words.hash.tolist())) == len(pairs)
    encoder = P.Encoder(P.default_tokenizer())
    ids, bounds = encoder.encode(words, buf)
    for i, t in enumerate(pairs):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == encoder.tokenizer.encode(t, add_special_tokens=False).ids
