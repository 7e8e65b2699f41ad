"""Word-piece token counts by a longest-match automaton with failure links."""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from riskloom.llm.common import doc_texts, field, slices

# A word: a run of letters and digits, or one other character that is no white space.
WORDS = r"\w+|[^\w\s]"
# Words remembered per generation; two generations bound a worker's memory.
REMEMBERED = 300_000
_MARK = "▁"


class Automaton(dict):
    """Number of greedy longest-match pieces of a word; 0 for a word that cannot be written. A map that fills itself.

    The trie holds the pieces that begin a word and, below a second root, those that
    continue one. Where a node has no edge for the next letter, the greedy split up to
    there is already known: `pops` counts its pieces and `fail` is the node that spells
    what they leave over. So each letter is read once, and no piece is ever built.
    """

    def __init__(self, begins: Iterable[str], continues: Iterable[str]):
        self.next: list[dict[str, int]] = [{}, {}]  # 0 begins a word, 1 continues it
        ends = [False, False]
        for root, pieces in ((0, begins), (1, continues)):
            for piece in pieces:
                node = root
                for letter in piece:
                    child = self.next[node].get(letter)
                    if child is None:
                        child = self.next[node][letter] = len(self.next)
                        self.next.append({})
                        ends.append(False)
                    node = child
                ends[node] = ends[node] or node > 1
        self.fail, self.pops = [-1] * len(self.next), [0] * len(self.next)
        queue = deque([0, 1])
        while queue:
            parent = queue.popleft()
            for letter, node in self.next[parent].items():
                if ends[node]:
                    self.fail[node], self.pops[node] = 1, 1
                else:
                    back, popped = self.fail[parent], self.pops[parent]
                    while back >= 0 and letter not in self.next[back]:
                        popped += self.pops[back]
                        back = self.fail[back]
                    if back >= 0:
                        self.fail[node], self.pops[node] = self.next[back][letter], popped
                queue.append(node)
        self.old: dict[str, int] = {}

    def match(self, word: str) -> int:
        node, count = 0, 0
        follow, fail, pops = self.next, self.fail, self.pops
        for letter in word:
            while letter not in follow[node]:
                count += pops[node]
                node = fail[node]
                if node < 0:
                    return 0
            node = follow[node][letter]
        while node > 1:
            count += pops[node]
            node = fail[node]
        return count if node == 1 else 0

    def __missing__(self, word: str) -> int:
        count = self.old.get(word)
        if count is None:
            count = self.match(word)
        if len(self) >= REMEMBERED:
            self.old = dict(self)
            self.clear()
        self[word] = count
        return count


@lru_cache(maxsize=2)
def vocabulary(path: str) -> tuple[list[str], list[str]]:
    """Pieces of a sentencepiece file: those marked as a word's beginning, and the others."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    begins = [p[len(_MARK) :] for p in pieces if p.startswith(_MARK)]
    return [p for p in begins if p], [p for p in pieces if not p.startswith(_MARK)]


@lru_cache(maxsize=2)
def automaton(path: str) -> Automaton:
    """One per Python worker."""
    return Automaton(*vocabulary(path))


def count_pieces(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", words: str = WORDS
) -> DataFrame:
    """`id_col`, `n_words`, `n_pieces`, `n_unknown` for every row, over the whole text.

    A word that the vocabulary cannot write counts as one piece and as unknown. Null
    and empty texts have none of each; null ids and repeated rows stay; an empty table
    gives an empty result; other columns are ignored.
    """
    rows = doc_texts(docs, id_col, text_col)
    names = [id_col, "n_words", "n_pieces", "n_unknown"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, find = automaton(path), re.compile(words).findall
        for batch in slices(batches):
            totals = []
            for text in batch.column(1):
                counts = list(map(lengths.__getitem__, find(text.as_py())))
                unknown = counts.count(0)
                totals.append((len(counts), sum(counts) + unknown, unknown))
            columns = [pa.array(c, pa.int64()) for c in (zip(*totals) if totals else ((), (), ()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    schema = T.StructType([field(rows, id_col), *(T.StructField(n, T.LongType()) for n in names[1:])])
    return rows.mapInArrow(run, schema)
