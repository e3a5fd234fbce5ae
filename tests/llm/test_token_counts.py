import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tillhouse.llm.token_counts import PrefixCounter, longest_prefix, prefix_table, token_counts, tokens_in_prefix
from tillhouse.llm.vocabulary import read_file

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
COUNTER = PrefixCounter(read_file(PATH))
PARTS = ["a", " ", "  ", "\n", "\t", "'re", "'s", "'", "l", "hello", " world", "é", "中", "’", "23", "!!", "　", "\x1c"]
PARTS += ["<|endoftext|>", "<|endo", "\U0001f600", "Ᲊ", "THE", "tion"]


def n_tokens(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=12).map("".join))
def test_every_prefix_has_the_count_of_the_library(text):
    running, counts = 0, []
    for step in COUNTER.prefix_steps(text).tolist():
        running += step
        counts.append(running)
    assert counts == [n_tokens(text[:k]) for k in range(1, len(text) + 1)]


@pytest.mark.parametrize("limit", [0, 1, 3, 10, 1000])
def test_longest_prefix_within_a_budget(limit):
    text = "Unbelievable prefixes of 12345 words, don't they   shrink?"
    best = max(k for k in range(len(text) + 1) if n_tokens(text[:k]) <= limit)
    assert longest_prefix(COUNTER.prefix_steps(text), limit) == best


def test_odd_texts_and_repeated_rows(documents, odd_texts):
    docs = documents(odd_texts, extra=[(None, "no id", None, None, None)], repeat=True)
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(docs, PATH).collect())
    want = []
    for key, text in [*enumerate(odd_texts), (None, "no id")]:
        count = n_tokens(text or "")
        want += 2 * [(key or -1, len((text or "").encode()), count, count > 512)]
    assert got == sorted(want)


def test_empty_table(documents):
    assert token_counts(documents([]), PATH).count() == 0
    assert prefix_table(documents([]), PATH).count() == 0


def test_stored_prefixes_answer_questions(spark, documents):
    long_text = "a long text of many words, " * 4000
    table = prefix_table(documents([long_text, "short one", None]), PATH)
    asked = [(0, 0), (0, 70000), (0, 65536), (0, 10**9), (1, 5), (2, 3)]
    questions = spark.createDataFrame(asked, "doc_id long, n_chars long")
    got = {(r.doc_id, r.n_chars): r.n_tokens for r in tokens_in_prefix(table, questions).collect()}
    whole = {0: long_text, 1: "short one", 2: ""}
    assert got == {(d, n): n_tokens(whole[d][:n]) for d, n in asked}


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for row in token_counts(docs, PATH).collect():
        assert row.n_tokens == n_tokens(texts[row.doc_id])
        assert row.over_limit == (row.n_tokens > 512)
