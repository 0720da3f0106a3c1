import random
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from raremine.llm import token_counts as T


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def brute(library, rows):
    return Counter((i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 2048)
                   for i, t in rows)


def counted(df):
    return Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in df.collect())


def hard_texts():
    r = random.Random(5)
    words = "plain don't it's we'LL 12ab34 café café Å 한 中文字 <|endoftext|> <|startoftext|> <|endof a̸= ... '' İI  x क़ \U0001f600\U0001f600   \t\n".split(" ")
    mixed = " ".join(r.choice(words) for _ in range(9000))
    glued = "".join(r.choice(words) for _ in range(5000))
    return [mixed, glued, "x" * 5000 + " y " + "z" * 9000, "a" * 20000, "ab1" * 4000, "中" * 7000, "é" * 6000,
            "한" * 3000, "e" + "̣́" * 4000 + " end", "<|endoftext|>" * 1500, "<|startoftext" * 900,
            " " * 9000, "'s" * 5000, "!" * 8000, "\n" * 300 + "word " * 3000, "क़" * 3000]


def test_equals_the_library(docs, rows, library):
    """Whole texts, with chunks so short that many are cut."""
    assert counted(T.count_tokens(docs)) == brute(library, rows)
    assert counted(T.count_tokens(docs, chunk=300, overlap=150)) == brute(library, rows)


def test_hard_texts(spark, library):
    rows = list(enumerate(hard_texts()))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert counted(T.count_tokens(df, chunk=700, overlap=100)) == brute(library, rows)
    assert counted(T.count_tokens(df, chunk=1024, overlap=65)) == brute(library, rows)


def test_splices_are_token_boundaries_of_the_whole(library):
    """Every word start that two chunks share is one of the whole text."""
    text = hard_texts()[0] + hard_texts()[1]
    whole = set(T.word_starts(library.encode(text, add_special_tokens=False), text, 0, len(text))[0])
    r = random.Random(1)
    for _ in range(60):
        a = r.choice(sorted(whole))                  # the left chunk starts right
        b = a + r.randrange(200, 900)
        left, right = text[a:b + 400], text[b:b + 1500]
        at_left = {a + p for p in T.word_starts(library.encode(left, add_special_tokens=False), left, 0, len(left) - T.MARGIN)[0]}
        at_right = {b + p for p in T.word_starts(library.encode(right, add_special_tokens=False), right, 0, len(right))[0]}
        assert at_left & at_right <= whole


def test_cuts_are_proven_for_this_vocabulary_only(spark, library):
    """Texts without splices: by distinct stretches or, for another vocabulary, whole."""
    assert T.cuts_are_proven(library)
    path = public_tokenizers.path("byte_bpe_50k.json")
    other = Tokenizer.from_file(path)
    assert not T.cuts_are_proven(other)
    texts = [t[:3000] for t in hard_texts()] + [" lead", "trail \x1c\x85\u2003x", "a\u0301 \u0301b", "<|endoftext|> <|endoftext|>x"]
    texts += ["<|ENDOFTEXT|>", "x<|endoftext|>Y,z", "'S 's 'Sx, 'LL,'ve.'re", "Don'T 5's 5'S a.b'c", "É,è;×y÷z.ÀB", "e\u0301,x .\u0301y", "A1B2,3.4-5", "\x00a\x7f,b",
              "=\u0338 x=\u0338,", "K\u212a Å\u212b ,\u212b"]
    r = random.Random(8)
    signs = "aB'sS.,<|>1 é×É\u0301\u0338…中 \n_-#endoftext"
    texts += ["".join(r.choice(signs) for _ in range(40)) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert counted(T.count_tokens(df)) == brute(library, list(enumerate(texts)))
    assert counted(T.count_tokens(df, vocabulary=path)) == brute(other, list(enumerate(texts)))


def test_overlaps_widen(spark, library, monkeypatch):
    """One word longer than chunk and overlap: rounds go on until a chunk holds it."""
    seen = []
    real = T._chunks
    monkeypatch.setattr(T, "_chunks", lambda long, chunk, overlap: seen.append((chunk, overlap)) or real(long, chunk, overlap))
    rows = [(1, "b " * 2000 + "a" * 3000 + " c" * 2000), (2, "short words only " * 400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert counted(T.count_tokens(df, chunk=500, overlap=100)) == brute(library, rows)
    assert seen[0] == (500, 100) and seen[1] == (2000, 400) and len(seen) >= 3


def test_empty_and_nulls(spark, empty, library):
    assert T.count_tokens(empty).count() == 0
    rows = [(None, None), (1, ""), (1, ""), (2, " \n ")]
    out = counted(T.count_tokens(spark.createDataFrame(rows, "doc_id long, text string")))
    assert out == Counter({(None, 0, 0, False): 1, (1, 0, 0, False): 2, (2, 3, 0, False): 1})
    with pytest.raises(ValueError):
        T.count_tokens(empty, overlap=10)
