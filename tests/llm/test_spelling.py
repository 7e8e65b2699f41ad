"""Spelling variants against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from riskloom.llm import spelling


def near_words(words):
    """Each word's neighbours by trying all deletions, insertions and replacements that lead to a word."""
    letters = sorted({c for w in words for c in w})
    found = {}
    for w in words:
        tried = {w[:i] + w[i + 1 :] for i in range(len(w))}
        tried |= {w[:i] + c + w[j:] for i in range(len(w) + 1) for j in (i, i + 1) for c in letters}
        found[w] = [v for v in tried if v != w and v in words]
    return found


def brute(docs, slip=None, least_length=7, factor=10):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if slip and h % slip == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least_length and n >= 2}
    near = near_words(words)
    forms = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= factor * words[w]:
            forms[w] = best
    rows = []
    for w, n in words.items():
        root = w
        while root in forms:
            root = forms[root]
        rows.append((w, forms.get(w), root, n, len(near[w]), words[forms[w]] if w in forms else None))
    return sorted(rows, key=repr)


@pytest.fixture(scope="module")
def letters():
    """Texts of words over three letters, so that many are near each other; one word fills a third of all."""
    rng = random.Random(5)
    docs = []
    for i in range(60):
        words = ["".join(rng.choices("aBé", k=rng.choice((4, 5, 6)))) for _ in range(40)] + ["aaaaa"] * 30
        docs.append((i, " ".join(words) + ", " + "1".join(words[:9])))
    return docs


@pytest.mark.parametrize("part", [6, 8_192])
@pytest.mark.parametrize("slip", [None, 3])
def test_spelling_is_brute_force(spark, rows_of, monkeypatch, letters, part, slip):
    monkeypatch.setattr(spelling, "PART_WORDS", part)
    monkeypatch.setattr(spelling, "BORDER_LETTERS", 4 if part < 10 else 64)
    docs = spark.createDataFrame(letters, "doc_id long, text string")
    found = spelling.spelling_variants(docs, slip=slip, least_length=4, factor=2)
    wanted = brute(letters, slip, 4, 2)
    assert rows_of(found) == wanted and sum(r[1] is not None for r in wanted) > 50
    assert any(r[1] is not None and r[2] != r[1] for r in wanted)


def test_nodes_have_one_number_in_all_parts():
    """Prefixes get equal numbers exactly if they are equal, whichever part holds them."""
    rng = random.Random(3)
    words = sorted({"".join(rng.choices("abc", k=rng.randrange(1, 9))) for _ in range(400)})
    cuts = sorted({w[:5] for w in rng.sample(words, 30)})
    paths = spelling.border_paths(cuts)
    named: dict[str, int] = {}
    for part in range(len(cuts) + 1):
        low, high = (cuts[part - 1] if part else ""), (cuts[part] if part < len(cuts) else "￿")
        mine = [w for w in words if low <= w < high]
        nodes, starts = spelling.number_nodes(mine, part, cuts, paths)
        for w, at in zip(mine, starts):
            for i in range(len(w) + 1):
                assert named.setdefault(w[:i], int(nodes[at + i])) == nodes[at + i]
    assert len(set(named.values())) == len(named) == len({w[:i] for w in words for i in range(len(w) + 1)})


def test_query_is_brute_force(table, result):
    given = [(r["doc_id"], r["text"]) for r in table("documents").collect()]
    found = result("op11_spelling").astype(object)
    rows = [tuple(None if v != v else v for v in r) for r in found.itertuples(index=False)]
    assert sorted(rows, key=repr) == brute(given, 31)


def test_spelling_of_odd_texts(spark, odd_docs, rows_of):
    found = rows_of(spelling.spelling_variants(odd_docs, slip=31))
    assert found == brute([(r["doc_id"], r["text"]) for r in odd_docs.collect()], 31)
    assert spelling.spelling_variants(odd_docs.limit(0)).collect() == []


def test_long_words_cost_no_more_than_their_letters(spark, rows_of):
    """Words of 50 000 letters: pairs of prefix and suffix texts would fill gigabytes."""
    long_one = "ab" * 25_000
    texts = [f"{long_one} {long_one}c {long_one}", f"{long_one}c {long_one[:-1]}", f"{long_one[:-1]} " * 2]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {len(r["word"]): r["n_near"] for r in spelling.spelling_variants(docs).collect()}
    assert found == {49_999: 1, 50_000: 2, 50_001: 1}
