import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from conftest import SMALL
from edge import ROWS, documents, empty
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm.cutting_stock import plan, solve
from tidemark.llm.packing import pack
from tidemark.llm.tokens import WordTokens

PATH = public_tokenizers.path("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(PATH)
WORDS = WordTokens(PATH, remember=50)


def ids(text):
    return np.array([*PLAIN.encode(text or "", add_special_tokens=False).ids, 1], "<u4").tobytes()


chunks = st.sampled_from(["a", "B", "it's", "..", ".", ",", " ", "\n", "é", "É", "H̱", "İ", "Σ", "12", "½", "\x85", "\x1c", " ", "한", "ᄒ", "ᅡ", "'ll", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "ß", "-", "क़", "שׁ", "***", "ς", "Ö"])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(chunks, max_size=12).map("".join), max_size=3))
def test_word_tokens_equal_whole_texts(texts):
    assert [x + b"\1\0\0\0" for x in WORDS.ids(texts)] == [ids(t) for t in texts]


def check(rows, pieces, most_padding):
    texts = defaultdict(list)
    for doc, text in rows:
        texts[doc].append(ids(text))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
    assert set(by_doc) == set(texts)
    for doc, own in by_doc.items():
        if len(texts[doc]) > 1:
            continue
        whole, at = texts[doc][0], 0
        for p in sorted(own, key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(whole) // 4 and p["length"] > 0
            at += p["length"]
            assert p["ids_crc32"] == zlib.crc32(whole[4 * p["start"] : 4 * at])
        assert at == len(whole) // 4
    padding = 0
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    total = sum(len(x) // 4 for own in texts.values() for x in own)
    assert padding <= most_padding * total + 2048
    return padding / total


def test_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    check([(r["doc_id"], r["text"]) for r in docs.collect()], pack(docs).collect(), 0.01)


def test_edges(spark):
    check([(r[0], r[1]) for r in ROWS], pack(documents(spark)).collect(), 1.0)
    assert pack(empty(spark)).count() == 0


def test_few_fillers_are_padded_and_many_fill(spark):
    rows = [(i, "word " * (i * 37 % 1900), "en", "a", 1) for i in range(300)]
    for share, most in ((1, 0.0), (10_000, 0.06)):
        check([(r[0], r[1]) for r in rows], pack(documents(spark, rows), filler_share=share).collect(), most)


def test_plan_covers_and_comes_near_the_bound():
    rng = np.random.default_rng(2)
    for top, n in ((64, 20_000), (20, 3), (64, 1)):
        sizes, counts = np.unique(rng.integers(1, top + 1, n), return_counts=True)
        want = dict(zip(sizes.tolist(), counts.tolist()))
        patterns, got = plan(want, 64), defaultdict(int)
        for pattern, times in patterns:
            assert sum(s * k for s, k in pattern.items()) <= 64
            for s, k in pattern.items():
                got[s] += k * times
        assert dict(got) == want
        bound = solve(sizes, counts.astype(float), 64)[1].sum()
        assert sum(t for _, t in patterns) <= bound * 1.001 + 64
    assert plan({}, 64) == []


def test_simple_words_need_no_encoder():
    """Words of letters and marks get their ids from the merges; all ids stay those of the plain call."""
    plain, words = Tokenizer.from_file(PATH), WordTokens(PATH, remember=20)
    odd = [
        "", " ", "\x0b a\x0cb\r\n\tc  ", "Don't I'm we'll", "naïve, ÉCOLE!! ÿß µm ªº Ñandú&&&", "ΣΑΣ Σας İstanbul ﬁn", "x\x85y a\xa0b \x1cq",
        "été café.", "a1b2 ١٢ 3,5%", "--- ... $% _a_ a_b a-b (c) <|x|>", "end<|endoftext|>of <|EndOfText|>!", "日本 текст, 한국어!",
        "é<|startoftext|>É", "over the 'quoted' words", "�?", "a" * 3000, "Ωmega≠", "é" * 700 + "!?",
    ]
    for texts in (odd, odd[::-1], [], ["", ""], [" ".join(odd)] * 2):
        got = [np.frombuffer(ids, "<u4").tolist() for ids in words.ids(texts)]
        assert got == [plain.encode(t, add_special_tokens=False).ids for t in texts]

    class NoEncoder:
        def encode(self, *_, **__):
            raise AssertionError("a simple word went through the whole encoder")

    words._tokenizer = NoEncoder()
    text = "Fresh zuheitlich, mañanera!! ÜBERGRÖßE."
    assert np.frombuffer(words.ids([text])[0], "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids
