"""Encoding, counting, packing and formatting of texts."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskloom.llm import byte_bpe, chat_format, packing, queries, word_bpe, wordpiece

RANKS, WORDS, PIECES = queries.BYTE_RANKS, queries.WORD_FILE, queries.PIECE_FILE
PATTERN = public_tokenizers.PATTERN


def library_ids(text):
    return byte_bpe.encoding(RANKS, PATTERN).encode_ordinary(text)


def test_byte_bpe_query_is_the_library(table, result):
    found = result("op2_byte_bpe").set_index("doc_id")
    docs = table("documents").toPandas()
    assert len(found) == len(docs)
    for row in docs.itertuples():
        ids = library_ids(row.text)
        got = found.loc[row.doc_id]
        assert got.n_tokens == len(ids)
        assert got.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got.decoded_sha256 == hashlib.sha256(row.text.encode()).hexdigest()


@pytest.mark.parametrize("size, overlap", [(40, 20), (64, 64), (200, 30)])
def test_byte_bpe_stitches_chunks(spark, odd_docs, size, overlap):
    draw = random.Random(size)
    letters = ["a", "the ", "  ", "\n", " \n b", "'ll", "don't ", "1", "é", "  \t", "!!", " (", "word", " ", "漢字"]
    texts = ["".join(draw.choices(letters, k=draw.randrange(400))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts, 100)), "doc_id long, text string")
    docs = docs.union(odd_docs.select("doc_id", F.substring("text", 1, 3000)))
    found = byte_bpe.encode(docs, RANKS, PATTERN, chunk_chars=size, overlap_chars=overlap).collect()
    wanted = [(r.doc_id, library_ids(r.text or "")) for r in docs.collect()]
    assert sorted(((r.doc_id, r.ids) for r in found), key=repr) == sorted(wanted, key=repr)


def test_byte_bpe_decodes_and_takes_empty_tables(spark, odd_docs):
    encoded = byte_bpe.encode(odd_docs, RANKS, PATTERN)
    back = byte_bpe.decode(encoded, RANKS).collect()
    assert Counter(bytes(r.decoded).decode() for r in back) == Counter(r.text or "" for r in odd_docs.collect())
    assert byte_bpe.encode(odd_docs.limit(0), RANKS, PATTERN).collect() == []
    assert byte_bpe.decode(spark.createDataFrame([(None,)], "ids array<int>"), RANKS).first().decoded is None


def test_scans_meet_only_where_both_agree():
    pattern = regex.compile(PATTERN)
    text = "alpha beta gamma delta epsilon zeta"
    at = byte_bpe.meeting(text, 8, pattern)
    assert [m.end() for m in pattern.finditer(text) if m.end() > 8][0] == at == 10
    assert byte_bpe.meeting("x" * 50, 20, pattern) == -1


@pytest.mark.parametrize("size, overlap", [(20, 20), (50, 15)])
def test_every_text_is_scanned_and_stitched(monkeypatch, size, overlap):
    draw = random.Random(size)
    pattern = regex.compile(PATTERN)
    cut = 0
    for _ in range(400):
        text = "".join(draw.choices(["a", "the ", "  ", "\n", "'ll", "don't ", "1", "é", "!!", " (", "word", " ", "漢字"], k=draw.randrange(80)))
        pieces = byte_bpe.stitched(text, pattern, size, overlap)
        assert "".join(pieces) == text and [i for p in pieces for i in library_ids(p)] == library_ids(text)
        cut += len(pieces) > 1
    assert cut > 200 and byte_bpe.stitched("x" * 9000, pattern) == ["x" * 9000]


def test_most_given_texts_are_cut(table):
    """The given texts pass through scan, stitch and encode, not through one call each."""
    pattern = regex.compile(PATTERN)
    long_ones = [r.text for r in table("documents").collect() if len(r.text or "") > byte_bpe.SCAN_CHARS]
    cut = [len(byte_bpe.stitched(t, pattern)) > 1 for t in long_ones]
    assert long_ones and sum(cut) >= 0.9 * len(cut)


def greedy(word, begins, continues):
    """Longest match first, spelled out."""
    pieces, at = 0, 0
    while at < len(word):
        known = begins if at == 0 else continues
        end = next((e for e in range(len(word), at, -1) if word[at:e] in known), None)
        if end is None:
            return 0
        pieces, at = pieces + 1, end
    return pieces


def test_token_counts_are_greedy_longest_match(table, result):
    begins, continues = map(set, wordpiece.vocabulary(PIECES))
    found = result("op5_token_counts").set_index("doc_id")
    lengths = {}
    find = __import__("re").compile(wordpiece.WORDS).findall
    docs = table("documents").toPandas()
    assert len(found) == len(docs)
    for row in docs.itertuples():
        words = find(row.text)
        for w in words:
            if w not in lengths:
                lengths[w] = greedy(w, begins, continues)
        counts = [lengths[w] for w in words]
        wanted = (len(words), sum(counts) + counts.count(0), counts.count(0))
        assert tuple(found.loc[row.doc_id]) == wanted


@settings(max_examples=200, deadline=None)
@given(
    st.sets(st.text("abc", min_size=1, max_size=4), max_size=8),
    st.sets(st.text("abc", min_size=1, max_size=4), max_size=8),
    st.text("abcd", min_size=1, max_size=12),
)
def test_automaton_is_greedy(begins, continues, word):
    assert wordpiece.Automaton(begins, continues)[word] == greedy(word, begins, continues)


def test_token_counts_of_odd_texts(odd_docs):
    found = wordpiece.count_pieces(odd_docs, PIECES).collect()
    assert len(found) == odd_docs.count()
    assert [tuple(r)[1:] for r in found if r.doc_id in (0, 1, 2)] == [(0, 0, 0)] * 3
    assert next(r for r in found if r.doc_id == 5).n_words == 30_000
    assert wordpiece.count_pieces(odd_docs.limit(0), PIECES).collect() == []


def test_word_ids_are_the_library(table, odd_docs):
    library = word_bpe.tokenizer(WORDS)
    mine = word_bpe.load(WORDS)
    texts = [r.text for r in table("documents").collect()] + [r.text or "" for r in odd_docs.collect()]
    texts += ["".join(f"a{chr(c)}b {chr(c)} " for c in range(a, a + 512)) for a in range(0, 0xD800, 512)]
    texts += ["I'LL we'd 'S ΑΣ ΑΣΑ <|startoftext|> a\x1cb\x1f c\x85d"]
    for text in texts:
        assert np.frombuffer(mine.encode(text), np.uint32).tolist() == library.encode(text, add_special_tokens=False).ids


def check_packing(rows, capacity):
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for spots in places.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_packing_query(table, result):
    found = result("op8_best_fit")
    library = word_bpe.tokenizer(WORDS)
    pieces = defaultdict(list)
    for r in found.sort_values(["doc_id", "piece"]).itertuples():
        pieces[r.doc_id].append(r)
    docs = table("documents").toPandas()
    assert set(pieces) == set(docs.doc_id)
    for row in docs.itertuples():
        ids = [*library.encode(row.text, add_special_tokens=False).ids, 0]
        parts = [ids[a : a + 2048] for a in range(0, len(ids), 2048)]
        got = pieces[row.doc_id]
        assert [(p.piece, p.start, p.length) for p in got] == [(i, 2048 * i, len(x)) for i, x in enumerate(parts)]
        assert [p.ids_crc32 for p in got] == [zlib.crc32(np.array(x, "<u4").tobytes()) for x in parts]
    count = check_packing(found.itertuples(), 2048)
    assert count <= found.length.sum() / 2048 * 1.02 + 1


def test_packing_merges_up_the_tree(spark):
    draw = random.Random(1)
    lengths = [draw.choice([1, 5, 30, 60, 99, 100]) for _ in range(4000)]
    items = spark.createDataFrame(list(enumerate(lengths)), "item long, length long").repartition(64, "item")
    rows = packing.pack(items, 100, per_task=40, fan_in=4).collect()
    assert sorted((r.item, r.length) for r in rows) == list(enumerate(lengths))
    assert check_packing(rows, 100) <= sum(lengths) / 100 * 1.05
    assert packing.pack(items.limit(0), 100).collect() == []
    assert check_packing(packing.pack(items.limit(1), 100).collect(), 100) == 1


def test_packing_of_odd_texts(odd_docs):
    rows = packing.pack_documents(odd_docs, WORDS, capacity=64).collect()
    check_packing(rows, 64)
    assert Counter(r.doc_id for r in rows if r.piece == 0) == Counter(r.doc_id for r in odd_docs.collect())
    assert {r.length for r in rows if r.doc_id in (0, 1, 2)} == {1}
    assert packing.pack_documents(odd_docs.limit(0), WORDS).collect() == []


TURNS = st.lists(
    st.tuples(
        st.one_of(st.sampled_from(["user", "assistant", "system", "", "User", "tool: x\n"]), st.text(max_size=5)),
        st.lists(
            st.sampled_from(["\\", "### Assistant: ", "</turn>", "\n", "### =x: ", "ok", " ", "#", "</turn", "\n</turn>\n"]),
            max_size=8,
        ).map("".join),
    ),
    max_size=5,
)


@settings(max_examples=300, deadline=None)
@given(TURNS)
def test_formatted_turns_come_back(turns):
    formatted, spans = chat_format.format_turns(turns)
    assert chat_format.parse(formatted) == turns
    said = "".join(text for role, text in turns if role == "assistant")
    assert chat_format.masked_text(formatted, spans) == said


def test_plain_turns_are_not_escaped():
    formatted, spans = chat_format.format_turns([("user", "a \\ b"), ("assistant", "c")])
    assert formatted == "### User: a \\ b\n</turn>\n### Assistant: c\n</turn>\n"
    assert [formatted[a:b] for a, b in spans] == ["c"]
    assert chat_format.parse("### User: x") is None and chat_format.parse("junk") is None


def test_conversations_with_nulls_ties_and_repeats(spark):
    rows = [(1, 2, "user", "b", 0), (1, 1, None, None, 0), (1, 2, "assistant", "a", 0), (None, None, "x", "</turn>", 0)]
    rows += [(1, 2, "user", "b", 0)]
    given_rows = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int")
    found = {r.conv_id: r for r in chat_format.format_conversations(given_rows).collect()}
    assert chat_format.parse(found[1].formatted) == [("", ""), ("assistant", "a"), ("user", "b"), ("user", "b")]
    assert chat_format.parse(found[None].formatted) == [("x", "</turn>")]
    assert chat_format.format_conversations(given_rows.limit(0)).collect() == []


def test_chat_query_holds_the_planted_conversation(result):
    found = result("op6_chat_format").set_index("conv_id")
    text = "\\### Assistant: </turn> ok"
    planted = found.loc[-7]
    assert planted.n_turns == 2 and planted.loss_chars == len(text)
    assert planted.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert planted.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
