"""Prefix token counts against the tokenizers library, prefix by prefix."""

import random

import pytest
from tokenizers import Tokenizer

from wardflow.llm.common import vocabulary
from wardflow.llm.encode import Encoder, keys, unit_of
from wardflow.llm.token_counts import PrefixCounter, count_at, longest_prefix, token_prefixes

PARTS = ["a", "b", "the", "ing", " ", "  ", "\n", "\n\n", " \n", "\t", "'s", "'re", "'ll", "'", "!", "...", "----", "É", "é",
         " ", "　", "1", "234", "<|endoftext|>", "<|startoftext|>", "<|endof", "ß", "日本", "🙂", "\x1c", "\x85", "İ",
         "́", "</w>", "***", "CAP", "               "]


def _texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(PARTS, k=rng.randint(0, 12))) for _ in range(n)]


def test_every_prefix_counts_as_the_library_counts_it():
    path = vocabulary("byte_bpe_50k.json")
    counter, library = PrefixCounter(path), Tokenizer.from_file(path)
    for text in [*_texts(1500, 1), "", "internationalization" * 30, "=" * 200, " " * 150 + "x"]:
        table = counter.table(text)
        want = [len(e.ids) for e in library.encode_batch([text[:k] for k in range(len(text) + 1)], add_special_tokens=False)]
        assert [count_at(table, k) for k in range(len(text) + 1)] == want, repr(text)
        for budget in (0, 1, 3):
            assert longest_prefix(table, budget) == max(k for k, c in enumerate(want) if c <= budget)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_units_encode_as_the_whole_text(name):
    import numpy as np
    path = vocabulary(name)
    encoder, library = Encoder(path, most=50), Tokenizer.from_file(path)
    for text in _texts(3000, 2):
        assert "".join(map(unit_of, keys(text))) == text
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


LETTERS = ["ab", "Word", "É", "straße", "Übung", "ÿ", "÷", "ª", "µ", "x\u0301", "İ", "Ā", "1", "the", "'s", "'", "...", "%%%", ",", "</w>",
           "<|endoftext|>", "<|", "-", "日", " ", " ", " ", "\n", "\n", "\t"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_plain_words_go_to_the_model_alone_and_get_the_ids_of_the_library(name):
    import numpy as np
    path, rng, sent = vocabulary(name), random.Random(7), []
    encoder, library = Encoder(path, most=60), Tokenizer.from_file(path)
    whole = encoder._by_library
    encoder._by_library = lambda parts: sent.extend(parts) or whole(parts)
    texts = ["".join(rng.choices(LETTERS, k=rng.randint(0, 14))) for _ in range(4000)]
    for at in range(0, len(texts), 50):
        for text, ids in zip(texts[at:at + 50], encoder.many(texts[at:at + 50]), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
    sent.clear()
    encoder.many(["Every word, straße\nor \"not\"; Übung... x1 plainly"])
    assert sent == [' "not";', " x1"]
    assert len(encoder.marks) < 20_000


def test_other_patterns_are_left_to_the_library(tmp_path):
    import json
    import numpy as np
    with open(vocabulary("byte_bpe_50k.json"), encoding="utf-8") as file:
        said = json.load(file)
    said["normalizer"] = {"type": "Replace", "pattern": {"String": "e"}, "content": "a"}
    path = str(tmp_path / "other.json")
    with open(path, "w", encoding="utf-8") as file:
        json.dump(said, file)
    encoder, library = Encoder(path), Tokenizer.from_file(path)
    assert not encoder.cuts_at_letters
    assert np.frombuffer(encoder.ids("the best here, yes"), "<u4").tolist() == library.encode("the best here, yes", add_special_tokens=False).ids


def test_rows_of_every_kind(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "the " * 3000, "x"), (3, "the " * 3000, "x"), (None, "hi", "x")],
                                 "doc_id long, text string, n_tokens string")
    got = {(r.doc_id, r.n_bytes, r.n_tokens, r.fit_chars) for r in token_prefixes(docs, vocabulary("byte_bpe_50k.json")).collect()}
    assert {(1, 0, 0, 0), (2, 0, 0, 0), (None, 2, 1, 2)} < got
    long = next(r for r in got if r[0] == 3)
    assert long[1:3] == (12000, 3001) and 4 * 1023 <= long[3] <= 4 * 1024
    assert token_prefixes(docs.limit(0), vocabulary("byte_bpe_50k.json")).collect() == []


def test_counts_without_tables_are_those_of_the_tables():
    counter = PrefixCounter(vocabulary("byte_bpe_50k.json"), most=40)
    for text in [None, "", "the " * 300, "日本" * 90 + " x", *[" ".join(_texts(6, seed)) for seed in range(400)]]:
        table = counter.table(text)
        for budget in (0, 1, 2, 7, 20, 1024):
            assert counter.counted(text, budget) == (count_at(table, len(table)), longest_prefix(table, budget)), (text, budget)
