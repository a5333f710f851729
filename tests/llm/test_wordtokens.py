import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from reelkpi.llm import wordtokens

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
OWN = wordtokens.UnitEncoder(PATH)


def check(texts):
    want = [e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in OWN.encode(texts)] == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=8))
def test_any_text(texts):
    check(texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab<|C9ÀÉéß×÷ÿ .,!*$'\n\x1c\x85\xa0́　ſK", max_size=60), max_size=8))
def test_marks_accents_spaces(texts):
    check(texts)


def test_words_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    check([d.text for d in docs])


def test_bounded_table(monkeypatch):
    monkeypatch.setattr(wordtokens, "UNIT_CACHE", 5)
    for i in range(30):
        check([f"word{i} Other{i % 4}. and, <|endoftext|> <|endoftext|>x the{i}*** É{i} été. été"])


def test_special_strings_keep_their_case():
    check(["<|endoftext|> <|ENDOFTEXT|>", "x<|startoftext|>y", "A.b,C É.x ×a÷ ÿÞ don't D'ont 12a.", "", " ", "a", "\n"])
