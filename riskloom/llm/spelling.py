"""Spelling variants by pairs of trie nodes."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.exprs import quoted
from riskloom.session import broadcastable, discard, materialize, ship_package

LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH = 7
LEAST_COUNT = 2
# A form occurs at least so many times as often as its variant.
FACTOR = 10
# Words whose trie one task builds, and the letters of the borders between them.
PART_WORDS = 8_192
BORDER_LETTERS = 64
# Words drawn for each border.
DRAWN = 16
# What a word has at a key: its own letter skipped, the same and the last of a run of equal letters, nothing skipped.
SKIP, SKIP_LAST, WHOLE = 0, 1, 2


def lower_ascii(text: Column) -> Column:
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, capitals, capitals.lower())


def word_counts(
    docs: DataFrame, id_col: str, text_col: str, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, slip: int | None = None
) -> DataFrame:
    """`word`, `n`: the runs of letters, capitals of ASCII in lower case, that are long and frequent enough.

    With `slip`, a letter is left out of every run whose hash with the id it divides.
    """
    found = F.regexp_extract_all(F.col(text_col), F.lit(f"[{LETTERS}]{{{least_length},}}"), F.lit(0))
    words = docs.select(F.col(id_col).alias("doc"), F.explode(found).alias("run")).select("doc", lower_ascii(F.col("run")).alias("word"))
    if slip:
        key = F.concat(F.coalesce(F.col("doc").cast("string"), F.lit("")), F.lit(":"), "word")
        words = words.select("word", F.crc32(key.cast("binary")).alias("h"))
        at = (F.col("h") % F.length("word")).cast("int")
        cut = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
        words = words.select(F.when(F.col("h") % slip == 0, cut).otherwise(F.col("word")).alias("word"))
    counts = words.where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= least_count)


def borders(words: DataFrame, count: int, backward: bool) -> list[str]:
    """Words that cut the dictionary, read forward or backward, into parts of some `PART_WORDS` words.

    They come from a bounded hashed sample and only bound the tasks; no result depends on them.
    """
    parts = count // PART_WORDS
    if not parts:
        return []
    every = max(1, count // (parts * DRAWN))
    word = F.reverse("word") if backward else F.col("word")
    drawn = words.where(F.pmod(F.xxhash64("word"), F.lit(every)) == 0).select(F.substring(word, 1, BORDER_LETTERS)).collect()
    found = sorted({r[0] for r in drawn})
    step = max(1, len(found) // (parts + 1))
    return found[step::step]


def _shared(a: str, b: str) -> int:
    """Letters that both begin with."""
    least = min(len(a), len(b))
    if a[:least] == b[:least]:
        return least
    return next(i for i in range(least) if a[i] != b[i])


def border_paths(cuts: list[str]) -> list[list[int]]:
    """Numbers of the trie nodes on the way to each border (sorted), the root's first; all are negative."""
    paths: list[list[int]] = []
    fresh, before = -2, ""
    for cut in cuts:
        same = _shared(before, cut)
        path = paths[-1][: same + 1] if paths else [-1]
        path += range(fresh, fresh - (len(cut) - same), -1)
        fresh -= len(cut) - same
        paths.append(path)
        before = cut
    return paths


def number_nodes(words: list[str], part: int, cuts: list[str], paths: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the trie nodes of one part's words (sorted, all between the part's two borders), one after the other.

    Returns also where each word's nodes begin; a word has one more than letters. A
    prefix that words of other parts have too is one of a border, and has the border's
    number everywhere; the other nodes are numbered as they come.
    """
    starts = np.concatenate(([0], np.cumsum([len(w) + 1 for w in words], dtype=np.int64)))
    nodes = np.empty(starts[-1], np.int64)
    ends = [(cuts[i], paths[i]) for i in (part - 1, part) if 0 <= i < len(cuts)]
    fresh, path, before = part << 40, [-1], ""
    for at, word in zip(starts, words):
        same = _shared(before, word)
        del path[same + 1 :]
        shared, known = max(((_shared(cut, word), p) for cut, p in ends), default=(0, path), key=lambda x: x[0])
        if shared > same:
            path += known[same + 1 : shared + 1]
            same = shared
        path += range(fresh, fresh + len(word) - same)
        fresh += len(word) - same
        nodes[at : at + len(word) + 1] = path
        before = word
    return nodes, starts


def _parted(words: DataFrame, cuts: list[str], backward: bool) -> DataFrame:
    """The same rows with the number of their part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = batch.column(0).to_pylist()
            part = [bisect_right(cuts, w[::-1] if backward else w) for w in given]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part, pa.int32())], names=[*names, "part"])

    names = words.columns
    fields = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in words.schema)
    return words.mapInArrow(run, f"{fields}, part int")


def with_prefix_nodes(words: DataFrame, cuts: list[str]) -> DataFrame:
    """`word`, `n`, `wid` (in the order of the words), `prefixes` (a node for each prefix, the empty one first)."""
    paths = border_paths(cuts)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        part = key[0].as_py()
        table = table.sort_by("word")
        nodes, starts = number_nodes(table["word"].to_pylist(), part, cuts, paths)
        prefixes = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(nodes))
        wid = pa.array(np.arange(table.num_rows, dtype=np.int64) + (part << 40))
        return pa.table([table["word"], table["n"], wid, prefixes], names=["word", "n", "wid", "prefixes"])

    return _parted(words, cuts, False).groupBy("part").applyInArrow(run, "word string, n long, wid long, prefixes array<long>")


def node_pairs(words: DataFrame, cuts: list[str]) -> DataFrame:
    """`p`, `s`, `kind`, `n`, `wid`: the node pairs around each letter of each word, and between its letters.

    Two words that differ in one letter share the pair around it; one that has a letter
    more has around that letter the pair that the other has between its letters.
    """
    paths = border_paths(cuts)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        backward = pa.array([w[::-1] for w in table["word"].to_pylist()], pa.string())
        table = table.append_column("backward", backward).sort_by("backward")
        words = table["word"].to_pylist()
        nodes, starts = number_nodes(table["backward"].to_pylist(), key[0].as_py(), cuts, paths)
        prefixes = table["prefixes"].combine_chunks().flatten().to_numpy()
        lengths = np.diff(starts)
        # The node of the suffix that begins at a place stands where that of the prefix that ends there does.
        mirrored = np.repeat(starts[:-1] + starts[1:] - 1, lengths) - np.arange(starts[-1])
        suffixes = nodes[mirrored]
        letters = np.ones(starts[-1], bool)
        letters[starts[1:] - 1] = False
        here = np.flatnonzero(letters)
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        last = np.ones(len(points), bool)
        last[:-1] = points[:-1] != points[1:]
        last[np.cumsum(lengths - 1) - 1] = True
        kinds = np.concatenate((np.where(last, SKIP_LAST, SKIP), np.full(starts[-1], WHOLE)))
        n, wid = (np.repeat(table[c].to_numpy(), lengths) for c in ("n", "wid"))
        columns = [
            np.concatenate((prefixes[here], prefixes)),
            np.concatenate((suffixes[here + 1], suffixes)),
            kinds.astype(np.int8),
            np.concatenate((n[here], n)),
            np.concatenate((wid[here], wid)),
        ]
        return pa.table([pa.array(c) for c in columns], names=["p", "s", "kind", "n", "wid"])

    return _parted(words, cuts, True).groupBy("part").applyInArrow(run, "p long, s long, kind byte, n long, wid long")


def neighbours(pairs: DataFrame) -> DataFrame:
    """`wid`, `n_near`, `best` (`n`, `back`): how many words are near a word, and the most frequent of them.

    All words of a pair have one letter between the same prefix and suffix, or none, so
    there are at most as many as letters and one more, and a word meets each of its
    neighbours at one pair: of a run of equal letters only the last stands for the run.
    """
    me = F.struct("wid", "kind", F.col("n").alias("n"))
    groups = pairs.groupBy("p", "s").agg(F.collect_list(me).alias("m")).where(F.size("m") > 1)

    def of(x: Column) -> Column:
        def near(o: Column) -> Column:
            letter = (x.kind != WHOLE) & (o.kind != WHOLE)
            added = ((x.kind == WHOLE) & (o.kind == SKIP_LAST)) | ((x.kind == SKIP_LAST) & (o.kind == WHOLE))
            return (o.wid != x.wid) & (letter | added)

        return F.transform(F.filter("m", near), lambda o: F.struct(o.n.alias("n"), (-o.wid).alias("back")))

    each = groups.select(F.explode(F.transform("m", lambda x: F.struct(x.wid.alias("wid"), of(x).alias("near")))).alias("x"))
    each = each.select("x.wid", F.size("x.near").alias("k"), F.array_max("x.near").alias("best")).where("k > 0")
    return each.groupBy("wid").agg(F.sum("k").alias("n_near"), F.max("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """`wid`, `root` from `wid`, `form`: the last of the forms. Counts grow along them by a factor, so they end."""
    up = materialize(forms.select("wid", F.col("form").alias("root")), "word-roots")
    while True:
        further = up.select(F.col("wid").alias("root"), F.col("root").alias("beyond"))
        moved = up.join(further, "root", "left").select("wid", F.coalesce("beyond", "root").alias("root"), "beyond")
        moved = materialize(moved, "word-roots")
        discard(up)
        up = moved.drop("beyond")
        if moved.where("beyond is not null").isEmpty():
            return up


def spelling_variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    slip: int | None = None,
    factor: int = FACTOR,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
) -> DataFrame:
    """`word`, `form`, `root`, `n`, `n_near`, `form_n` for every word of the texts.

    Words are runs of letters of some length that occur more than once; two are near
    if one letter inserted, deleted or replaced turns one into the other. A word's form
    is the most frequent word near it (of equally many the first), if that is
    `factor` times as frequent, and its root the last of the forms that follow.

    A null or empty text has no words; repeated rows count each; a null id hashes as an empty
    one; other columns are ignored; an empty table gives an empty one. The work for a
    word grows with its length, however long it is.
    """
    ship_package(docs.sparkSession)
    words = materialize(word_counts(docs, id_col, text_col, least_length, least_count, slip), "words")
    count = words.count()
    numbered = materialize(with_prefix_nodes(words, borders(words, count, False)), "word-prefixes")
    near = neighbours(node_pairs(numbered, borders(words, count, True)))
    near = numbered.select("wid", "n").join(near, "wid").select(
        "wid", "n_near", (-F.col("best.back")).alias("form"), F.col("best.n").alias("form_n"), (F.col("best.n") >= factor * F.col("n")).alias("is_form")
    )
    near = materialize(near, "near-words")
    discard(words)
    formed = near.where("is_form").select("wid", "form", "form_n")
    ends = materialize(formed.join(roots(formed), "wid"), "word-forms")
    # Few words are forms: their names are fetched for them alone.
    wanted = ends.select(F.explode(F.array("form", "root")).alias("wid")).distinct()
    names = broadcastable(materialize(numbered.select("wid", "word").join(wanted, "wid"), "form-names"))
    form, root = (names.select(F.col("wid").alias(c), F.col("word").alias(f"{c}_word")) for c in ("form", "root"))
    ends = ends.join(form, "form").join(root, "root").select("wid", "form_word", "root_word", "form_n")
    all_words = numbered.select("wid", "word", "n").join(near.select("wid", "n_near"), "wid", "left").join(ends, "wid", "left")
    return all_words.select(
        "word",
        F.col("form_word").alias("form"),
        F.coalesce("root_word", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        "form_n",
    )
