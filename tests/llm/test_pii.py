import re
import time

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from carelattice.llm import pii
from tests.llm.helpers import by_id, documents

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def naive(text):
    out = [(0, *m.span()) for m in EMAIL.finditer(text)]
    out += [(1, *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[ -]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


@settings(max_examples=400, deadline=None)
@given(st.one_of(
    st.text(alphabet="ab@.- +01259()é\n", max_size=60), st.text(max_size=30),
    st.lists(st.sampled_from(["a.b@c.de", "@", "a@b", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112",
                              "+1 (988) 555-2485", "+", " ", ".", "x", "00000.1.1.1", "5" * 20]), max_size=8).map("".join)))
def test_rules(text):
    assert pii.base_spans(text) == naive(text)
    for s, e in pii.candidate_spans(text, pii.base_spans(text)):
        assert all(e <= a or s >= b for _, a, b in pii.base_spans(text))


def test_long_runs_take_linear_time():
    for text in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "+1" * 100_000, "a@" * 100_000, "(1" * 100_000, "@" * 200_000):
        pii.base_spans(text)
        pii.candidate_spans(text, [])


@pytest.mark.parametrize("text", ["1 " + "a" * 1_000_000, "a" * 1_000_000 + "1", "1 " * 500_000 + "x", "1" + " " * 1_000_000, "1(" * 500_000 + "x",
                                  "no 1234567 " * 100_000, "1 " + "ab " * 300_000 + "1234567"])
def test_a_megabyte_takes_little_time(text):
    begun = time.process_time()
    pii.all_spans(text, {"passport no": "card"})
    list(pii._edges([pa.RecordBatch.from_arrays([pa.array([text])], names=["text"])]))
    assert time.process_time() - begun < 5


@pytest.mark.parametrize("text, found", [
    ("call (555) 123 4567 now", ["(555) 123 4567"]), ("passport no 123 456 789 was", ["123 456 789"]),
    ("(555) 123 4567, or", ["(555) 123 4567"]), ("a 12 34 b 1234567", ["1234567"]), ("of 1234567) x", ["1234567"]),
    ("id AB-1234-x. and abc", ["AB-1234-x"]), ("12 345 6 - ", []), ("x@y and user@host_1 z", ["user@host_1"]),
])
def test_candidates(text, found):
    assert [text[s:e] for s, e in pii.candidate_spans(text, [])] == found


def test_patterns_reach_back_over_any_length():
    far = "x" * 500
    for text, want in ((f"{far} {far} 1234567", f"{far} {far}"), ("Passport NO" + " " * 300 + "\n1234567", "passport no"),
                       ("no 1234567", None), ("a no-1234567", None), (f"the {far}\t1234567", f"the {far}"), ("1234567", None)):
        assert pii.Words(text).pattern_before(text.index("1234567")) == want


def test_patterns_find_unseen_identifiers_and_spare_the_rest(spark):
    seeds = [f"please call us at +1 (988) 555-{1000 + i} today about order item" for i in range(30)]
    hidden = ["please call us at 988-555-7777 today", "Call us  at 988.555.8888 now"]
    plain = ["we met at 1000000 and of the 4111111 number", "of the +1 (988) 555-2485 of the dog of the cat of the end"] * 3
    texts = seeds + hidden + plain + [None, "", "+1 (988) 555-2485"]
    docs = documents(spark, texts)
    patterns = pii.learn_patterns(docs)
    assert patterns == {"us at": "phone"}
    found = {r["doc_id"]: r for r in pii.find(docs, patterns).collect()}
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        base = [(s["kind"], s["start"], s["end"]) for s in found[i]["base"]]
        assert base == [(pii.KINDS[k], s, e) for k, s, e in naive(text or "")]
        added = [(text or "")[s["start"]:s["end"]] for s in found[i]["spans"] if (s["kind"], s["start"], s["end"]) not in base]
        assert added == (["988-555-7777"] if i == 30 else ["988.555.8888"] if i == 31 else [])
    masked = {r["doc_id"]: r["text"] for r in pii.mask(docs, patterns).collect()}
    assert masked[0] == "please call us at <PHONE> today about order item" and masked[30] == "please call us at <PHONE> today"
    assert masked[32] == plain[0] and masked[len(texts) - 3] is None
    assert pii.mask(docs, patterns).columns == docs.columns


def test_second_round_uses_first_finds(spark):
    """What one pattern discovers lets another pattern in, which discovers more."""
    texts = [f"my number is +1 (988) 555-{1000 + i} ok" for i in range(10)]
    texts += [f"my number is 988-555-{2000 + i} ok" for i in range(5)]
    texts += [f"dial fast 988-555-{2000 + i} ok" for i in range(5)] + ["dial fast 988-555-9999 ok"]
    docs = documents(spark, texts)
    assert pii.learn_patterns(docs, rounds=1) == {"number is": "phone"}
    assert pii.learn_patterns(docs, rounds=2) == {"number is": "phone", "dial fast": "phone"}


def test_nulls_repeats_empty(spark):
    docs = documents(spark, [(None, "a@b.cd"), (1, "a@b.cd"), (1, "a@b.cd"), (2, None)])
    assert pii.learn_patterns(docs) == {} == pii.learn_patterns(docs.limit(0))
    got = by_id(pii.find(docs, {}).select("doc_id", pii.listed("spans").alias("s")), "doc_id", "s")
    assert got == [(1, "email:0:6"), (1, "email:0:6"), (2, ""), (None, "email:0:6")]
    assert pii.find(docs.limit(0), {}).collect() == []
    assert pii.masked("a@b.cd and 4111 1111 1111 1111", {}) == "<EMAIL> and <CARD>"


def test_rare_patterns_count_however_many_numbers_there_are(spark):
    seeds = [f"her passport no a{i}@b.cd ok" for i in range(3)]
    numbers = ["go to 1234567 " * 41_000] * 10
    docs = documents(spark, seeds + ["the passport no AB1234567 ok"] + numbers, extra=False)
    patterns = pii.accepted_patterns(docs)
    assert [tuple(r) for r in patterns.collect()] == [("passport no", "email")]
    assert pii.mask(docs.where("doc_id = 3"), patterns).first()["text"] == "the passport no <EMAIL> ok"


def test_many_patterns_are_joined(spark):
    """With room for one pattern in a task, pairs and rows are joined, and nothing changes."""
    texts = [f"my number is +1 (988) 555-{1000 + i} ok" for i in range(20)]
    texts += [f"my number is 988-555-{2000 + i} ok" for i in range(5)] + [f"dial fast 988-555-{2000 + i} ok" for i in range(5)]
    texts += ["dial fast 988-555-9999 ok", "my number is 988-555-2001 ok", None, "", "no number"]
    docs = documents(spark, texts + ["dial fast 988-555-9999 ok"])
    few, many = pii.accepted_patterns(docs), pii.accepted_patterns(docs, in_task=1)
    assert by_id(few, "pattern", "as") == by_id(many, "pattern", "as") == [("dial fast", "phone"), ("number is", "phone")]
    assert by_id(pii.find(docs, few), "doc_id", "base", "spans") == by_id(pii.find(docs, many, in_task=1), "doc_id", "base", "spans")
    joined = pii.mask(docs, many, in_task=1)
    assert joined.columns == docs.columns
    assert by_id(pii.mask(docs, few), "doc_id", "text") == by_id(joined, "doc_id", "text")
    assert sum(r["text"] == "dial fast <PHONE> ok" for r in joined.collect()) == 7
