"""Runs: stretches of words that repeat with a period, found by suffix trees.

A run is a longest stretch with smallest period q, of at least two periods and 12 words.  Each run
holds the longest Lyndon word from one of its places on, in the order of the words or in the
opposite one, as one period.  So the Lyndon words of both orders are the candidates: one from i to
j is extended to the right by what the texts from i and from j on have in common, and to the left
by what those before i and j have.  Both questions go to suffix trees, built by Ukkonen's way, of
the text and of its reversal: the lowest node between two leaves of a tour tells what they have in
common, and a table of lowest nodes over powers of two answers in constant time.

A period of a run puts equal windows of six words into one stretch of such windows.  Words outside
of stretches with two equal windows are in no run and get no tree; stretches of many texts share a
tree, kept apart by symbols that occur once and sort before all words.

Defined results: null and wordless texts have no words and no runs; repeated rows, and rows of equal
or null id, are judged each by itself; runs come by start, then period; words are compared as bytes.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from basketry import shared
from basketry.llm import words

shared.ship(__name__)

MIN_WORDS = 12
#: Words that share a tree; a longer stretch has its own.
TREE_WORDS = 1 << 14


def suffix_tree(symbols: list[int]) -> tuple[dict[int, int], list[int], list[int], int]:
    """Ukkonen's tree: children by ``node * width + symbol``, edge starts and ends, and the width.

    The last symbol occurs once.  Leaves are made in the order of their suffixes.
    """
    size, width = len(symbols), max(symbols) + 1
    starts, ends, links = [0], [0], [0]
    children: dict[int, int] = {}
    node = edge = length = remaining = 0
    for i, symbol in enumerate(symbols):
        remaining += 1
        unlinked = 0
        while remaining:
            if not length:
                edge = i
            key = node * width + symbols[edge]
            child = children.get(key)
            if child is None:
                children[key] = len(starts)
                starts.append(i)
                ends.append(size)
                links.append(0)
                if unlinked:
                    links[unlinked] = node
                    unlinked = 0
            else:
                begin = starts[child]
                span = ends[child] - begin
                if length >= span:
                    edge += span
                    length -= span
                    node = child
                    continue
                if symbols[begin + length] == symbol:
                    if unlinked:
                        links[unlinked] = node
                    length += 1
                    break
                split = len(starts)
                starts += (begin, i)
                ends += (begin + length, size)
                links += (0, 0)
                children[key] = split
                children[split * width + symbol] = split + 1
                starts[child] = begin = begin + length
                children[split * width + symbols[begin]] = child
                if unlinked:
                    links[unlinked] = split
                unlinked = split
            remaining -= 1
            if node:
                node = links[node]
            elif length:
                length -= 1
                edge = i - remaining + 1
    return children, starts, ends, width


class Tree:
    """Leaves of a suffix tree in order, and the lowest node between two of them."""

    def __init__(self, symbols: list[int]):
        children, starts, ends, width = suffix_tree(symbols)
        self.size = len(symbols)
        keys = np.fromiter(children, np.int64, len(children))
        self.child = np.fromiter(children.values(), np.int64, len(children))
        self.parent, self.symbol = np.divmod(keys, width)
        begin, end = np.array(starts), np.array(ends)
        self.is_leaf = end == self.size
        self.is_leaf[0] = False
        self.above = np.zeros(len(starts), np.int64)
        self.above[self.child] = self.parent
        self.depth, up = end - begin, self.above
        while up.any():
            self.depth, up = self.depth + self.depth[up], up[up]

    def tour(self, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of all suffixes, children being visited by ``order[symbol]``, and depths of the lowest nodes.

        The depth at a rank is that of the lowest node between this leaf and the one before.
        """
        by = np.lexsort((-order[self.symbol], self.parent))
        child = self.child[by].tolist()
        edges = np.searchsorted(self.parent[by], np.arange(len(self.above) + 1)).tolist()
        visited, stack = [], [0]
        visit, take, put = visited.append, stack.pop, stack.extend
        while stack:
            node = take()
            visit(node)
            put(child[edges[node] : edges[node + 1]])
        nodes = np.array(visited)
        at = np.flatnonzero(self.is_leaf[nodes])
        # The node after a leaf is a child of the lowest node before the next leaf.
        lowest = np.zeros(self.size, np.int32)
        lowest[1:] = self.depth[self.above[nodes[at[:-1] + 1]]]
        suffix = np.cumsum(self.is_leaf) - 1
        rank = np.empty(self.size, np.int64)
        rank[suffix[nodes[at]]] = np.arange(self.size)
        return rank, lowest


class Common:
    """How many symbols two suffixes have in common at their beginning."""

    def __init__(self, rank: np.ndarray, lowest: np.ndarray):
        self.rank, self.tables = rank, [lowest]
        step = 1
        while 2 * step <= len(lowest):
            last = self.tables[-1]
            self.tables.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        a, b = self.rank[a], self.rank[b]
        low, high = np.minimum(a, b) + 1, np.maximum(a, b) + 1
        level = np.frexp((high - low).astype(float))[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(level).tolist():
            at = np.flatnonzero(level == k)
            table = self.tables[k]
            out[at] = np.minimum(table[low[at]], table[high[at] - (1 << k)])
        return out


def next_smaller(rank: np.ndarray) -> np.ndarray:
    """Place of the next smaller suffix: where the longest Lyndon word from each place on ends."""
    values = rank.tolist()
    ends = [len(values)] * len(values)
    open_places: list[int] = []
    for i, value in enumerate(values):
        while open_places and values[open_places[-1]] > value:
            ends[open_places.pop()] = i
        open_places.append(i)
    return np.array(ends)


def runs_of(parts: list[np.ndarray], least: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and periods of the runs of some sequences of numbers, places counted over all of them."""
    every = np.concatenate(parts)
    kinds = int(every.max()) + 1
    sizes = np.array([len(p) for p in parts])
    marks = np.concatenate([[0], np.cumsum(sizes + 1)])
    symbols = np.empty(marks[-1] + 1, np.int64)
    symbols[marks] = kinds + np.arange(len(marks))
    is_word = np.ones(len(symbols), bool)
    is_word[marks] = False
    symbols[is_word] = every
    place = np.flatnonzero(is_word)

    rising = np.arange(kinds + len(marks))
    rising[kinds:] = -1 - np.arange(len(marks))
    falling = rising.copy()
    falling[:kinds] = kinds - rising[:kinds]
    tree = Tree(symbols.tolist())
    rank, lowest = tree.tour(rising)
    after = Common(rank, lowest)
    a = np.concatenate([place, place])
    b = np.concatenate([next_smaller(rank)[place], next_smaller(tree.tour(falling)[0])[place]])
    del tree
    backward = Tree(symbols[::-1].tolist())
    before = Common(*backward.tour(rising))
    del backward

    last = len(symbols) - 1
    start = a - before(last - (a - 1), last - (b - 1))
    end = b + after(a, b)
    period = b - a
    long = end - start >= np.maximum(2 * period, least)
    found = np.unique(np.stack([start[long], period[long], end[long]]), axis=1)
    number = np.cumsum(is_word) - 1
    return number[found[0]], number[found[2] - 1] + 1, found[1]


def stretches(got: words.Words, least: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of words, each of one text, that may hold runs."""
    size = (least + 1) // 2
    windows = words.windows(got.hashes(), size)
    at = np.flatnonzero(got.left() >= size)
    keys = words.mix(windows[at] + got.text_of[at].astype(np.uint64))
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    one, other = at[order[:-1][same]], at[order[1:][same]]

    def covered(places):
        steps = np.zeros(len(got) + 1, np.int64)
        np.add.at(steps, places, 1)
        np.add.at(steps, places + size, -1)
        inside = np.cumsum(steps[:-1]) > 0
        # Stretches end with their text.
        begins = inside & np.concatenate([[True], ~inside[:-1] | (got.text_of[1:] != got.text_of[:-1])])
        return inside, begins

    if not len(one):
        return one, one
    # Equal windows count if one stretch holds both of them.
    _, begins = covered(np.concatenate([one, other]))
    stretch = np.cumsum(begins)
    near = stretch[one] == stretch[other]
    inside, begins = covered(np.concatenate([one[near], other[near]]))
    start = np.flatnonzero(begins)
    end = np.flatnonzero(inside & np.concatenate([~inside[1:] | begins[1:], [True]])) + 1
    long = end - start >= least
    return start[long], end[long]


def _symbols(got: words.Words, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """The words of each stretch as numbers, equal ones for equal words only."""
    sizes = end - start
    first = np.cumsum(sizes) - sizes
    every = np.repeat(start - first, sizes) + np.arange(sizes.sum())
    steps = np.zeros(len(got.data) + 1, np.int8)
    steps[got.starts[every]] = 1
    steps[got.ends[every]] -= 1
    letters = got.data[np.cumsum(steps[:-1], dtype=np.int8) > 0]
    offsets = np.concatenate([[0], np.cumsum(got.ends[every] - got.starts[every])]).astype(np.int32)
    coded = pa.Array.from_buffers(
        pa.binary(), len(every), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]
    ).dictionary_encode()
    return np.split(coded.indices.to_numpy().astype(np.int64), first[1:])


def find_runs(got: words.Words, least: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and periods of all runs, by start, then period."""
    start, end = stretches(got, least)
    if not len(start):
        return start, start, start
    parts = _symbols(got, start, end)
    total = np.cumsum(end - start)
    out = []
    i = 0
    while i < len(parts):
        done = total[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(total, done + TREE_WORDS, "right")))
        place = np.concatenate([np.arange(s, e) for s, e in zip(start[i:j], end[i:j], strict=True)])
        # Small numbers make small keys.
        some = np.unique(np.concatenate(parts[i:j]), return_inverse=True)[1]
        sizes = (end - start)[i : j - 1]
        s, e, q = runs_of(np.split(some, np.cumsum(sizes)), least)
        out.append((place[s], place[e - 1] + 1, q))
        i = j
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _rows(texts: list[bytes | None], least: int) -> dict:
    got = words.Words(texts)
    start, end, period = find_runs(got, least)
    dropped = np.zeros(len(got) + 1, np.int64)
    np.add.at(dropped, start + period, 1)
    np.add.at(dropped, end, -1)
    dropped = np.cumsum(dropped[:-1]) > 0
    cuts = np.searchsorted(start, got.first)
    collapsed, runs = [], []
    for i, text in enumerate(texts):
        own = (text or b"").split()
        begin, stop = cuts[i], cuts[i + 1]
        if begin < stop:
            kept = ~dropped[got.first[i] : got.first[i + 1]]
            own = [own[j] for j in np.flatnonzero(kept).tolist()]
        collapsed.append(b" ".join(own))
        runs.append(
            [
                {"start": s, "length": e - s, "period": q}
                for s, e, q in zip(
                    (start[begin:stop] - got.first[i]).tolist(),
                    (end[begin:stop] - got.first[i]).tolist(),
                    period[begin:stop].tolist(),
                    strict=True,
                )
            ]
        )
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    return {
        "n_words": pa.array(got.counts, pa.int64()),
        "runs": pa.array(runs, kind),
        "collapsed": pa.array(collapsed, pa.binary()).cast(pa.string()),
    }


def detect(
    docs: DataFrame, least: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text", carry: bool = False
) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every document, with ``carry`` also its row.

    ``runs`` have ``start, length, period`` in words; ``collapsed`` are the words without what runs
    repeat after their first period, joined by a space.
    """
    docs = words.picked(docs, id_col, text_col, carry)

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = words.binary(batch.column(1))
            for start, end in words.text_slices(texts):
                yield words.result(batch, start, end, _rows(texts[start:end], least))

    return docs.mapInArrow(
        run,
        f"doc_id {words.kind_of(docs, 'doc_id')}, n_words bigint, "
        f"runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string{words.carried(docs)}",
    )
