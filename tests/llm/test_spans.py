"""Personal data in forms without digits, and added segments in dense lists."""

import random

import pytest

from wardflow.llm import pii


@pytest.fixture(scope="module")
def field():
    rng = random.Random(7)
    names, sites = ["jane.doe", "bob", "ann_lee", "max", "li.wei", "eva"], ["example.org", "mail.test.com", "site.net", "uni.edu"]
    return pii.fit([f"Write to {rng.choice(names)}@{rng.choice(sites)} or call +1 202 555 {rng.randint(1000, 9999)}, room {k} (see it)." for k in range(150)])


@pytest.mark.parametrize("mail", ["jane.doe(at)example(dot)org", "Jane.Doe(AT)Example(DOT)org", "bob(at)site.net"])
def test_rewritten_address_without_a_digit_is_found(spark, field, mail):
    text = f"Please write to {mail} soon"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert [(text[s.start:s.end], s.kind) for s in pii.personal_data(docs, field).first().spans] == [(mail, "email")]


@pytest.mark.parametrize("text", ["1.2.3.4 " * 300, "a@b.c," * 300, "1.2.3.4@b.c " * 200])
def test_added_segments_never_overlap_base_matches_in_dense_lists(text):
    class Same:
        def best(self, zone):
            return [x for x in pii.base_spans(zone) if x[2] == pii.base_spans(zone)[0][2]]

    assert pii.find(text, Same()) == pii.base_spans(text)
