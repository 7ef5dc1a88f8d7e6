"""Evaluation texts leaking into training text: BM25 index with block-max WAND.

The test items are cut into units (sentences) and indexed once; the index is small
by the size of the test set, which is checked, and goes to every task. Each document
is read whole as overlapping passages, and every passage is a query: WAND with block
maxima returns all units whose BM25 score, as a share of the unit's score against
itself, reaches the threshold. A unit is verified by what is its own: its numbers
and rare words, beside most of its wording, must stand in the passage. Units that
several items share say nothing of an item.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from operator import itemgetter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklore.session import spread

#: Tokens of a passage and between the starts of two passages; a sentence spans at most their difference.
PASSAGE, STEP = 72, 24
#: BM25 parameters and the least share of a unit's own score.
K1, B, THRESHOLD = 1.2, 0.75, 0.4
#: Postings of a block.
BLOCK = 32
#: Verification: least share of the unit's words, of its weight, of its own tokens, and least number of words and own tokens.
WORDS, WEIGHT, OWN, LEAST_WORDS, LEAST_OWN = 0.6, 0.65, 0.5, 7, 2
#: A stretch over several units: least number of words and of own tokens.
RUN_WORDS, RUN_OWN = 14, 4
#: A token is a unit's own if it is a number or is in at most so many items; a unit is shared if another item has this share of its weight.
RARE_ITEMS, SHARED = 3, 0.92
#: Most characters of all test items together, the proven bound of what is broadcast.
MOST_CHARS = 50_000_000

_UNIT = itemgetter(0)
_INVISIBLE = re.compile("[­​-‏‪-‮⁠-⁤﻿᠎]")
_BREAK = re.compile(r"(\w)[-‐‑]\s*\n[\s>|*]*(\w)")
_TOKEN = re.compile(r"[^\W_]+")
_SENTENCE = re.compile(r"(?<=[.?!])\s+|\n{2,}")
#: Letters of other scripts that look like Latin ones (fixed values).
_LOOKALIKE = str.maketrans("авеіјкмнорсѕтухԁɡһοαενικρτυ", "abeijkmhopcstyxdghoaevikptu")


def tokens(text: str) -> list[str]:
    """Words in one form: compatibility forms, hidden characters, broken words, accents and look-alikes resolved."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", _INVISIBLE.sub("", text)).lower().translate(_LOOKALIKE)
        text = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    else:
        text = text.lower()
    if "-\n" in text or "-" in text and "\n" in text:
        text = _BREAK.sub(r"\1\2", text)
    return _TOKEN.findall(text)


class Index:
    """Inverted index of the units with normalised BM25 impacts and block maxima."""

    def __init__(self, items: list[tuple[int, str]]):
        self.item: list[int] = []
        self.words: list[Counter] = []
        for item, text in items:
            for sentence in _SENTENCE.split(text):
                bag = Counter(tokens(sentence))
                if sum(n for t, n in bag.items() if len(t) > 1 and not t.isdigit()) >= 5:
                    self.item.append(item)
                    self.words.append(bag)
        df = Counter(t for w in self.words for t in w)
        of_items: dict[str, set[int]] = defaultdict(set)
        for item, w in zip(self.item, self.words, strict=True):
            for t in w:
                of_items[t].add(item)
        n = len(self.words)
        self.idf = {t: math.log(1 + (n - d + 0.5) / (d + 0.5)) for t, d in df.items()}
        self.own = [{t for t in w if any(c.isdigit() for c in t) or len(of_items[t]) <= RARE_ITEMS} for w in self.words]
        self.weight = [sum(self.idf[t] * c for t, c in w.items()) for w in self.words]
        self.shared = self._shared(of_items)
        avg = sum(sum(w.values()) for w in self.words) / max(n, 1)
        postings: dict[str, list[tuple[int, float]]] = defaultdict(list)
        for u, w in enumerate(self.words):
            norm = K1 * (1 - B + B * sum(w.values()) / avg)
            impact = {t: self.idf[t] * c * (K1 + 1) / (c + norm) for t, c in w.items()}
            total = sum(impact.values())
            for t, x in impact.items():
                postings[t].append((u, x / total))
        # of each token: its units, impacts, greatest impact, and the last unit and greatest impact of each block
        self.postings = {}
        for t, p in postings.items():
            units, impacts = [u for u, _ in p], [x for _, x in p]
            starts = range(0, len(p), BLOCK)
            self.postings[t] = (units, impacts, max(impacts), [units[min(i + BLOCK, len(p)) - 1] for i in starts], [max(impacts[i : i + BLOCK]) for i in starts])
        self.need = [max(LEAST_OWN, math.ceil(OWN * len(own))) for own in self.own]
        self.units_of: dict[str, list[int]] = defaultdict(list)
        owners: dict[str, set[int]] = defaultdict(set)
        for u, own in enumerate(self.own):
            for t in own:
                owners[t].add(self.item[u])
                self.units_of[t].append(u)
        self.owners = {t: sorted(i) for t, i in owners.items()}

    def _shared(self, of_items: dict[str, set[int]]) -> set[int]:
        """Units nearly all of whose weight another item has in one unit."""
        by_token: dict[str, list[int]] = defaultdict(list)
        for u, own in enumerate(self.own):
            for t in own:
                by_token[t].append(u)
        shared = set()
        for u, w in enumerate(self.words):
            for v in {v for t in self.own[u] for v in by_token[t] if self.item[v] != self.item[u]}:
                if sum(self.idf[t] * min(c, self.words[v][t]) for t, c in w.items()) >= SHARED * self.weight[u]:
                    shared.add(u)
        return shared

    def search(self, query: set[str], threshold: float = THRESHOLD) -> list[int]:
        """All units whose normalised score reaches ``threshold``: WAND with block maxima."""
        # [unit, place, units, impacts, greatest impact, last units of the blocks, their greatest impacts]
        lists = [[p[0][0], 0, *p] for t in query if (p := self.postings.get(t)) is not None]
        if sum(x[4] for x in lists) < threshold:
            return []
        found = []
        while lists:
            lists.sort(key=_UNIT)
            bound, pivot = 0.0, -1
            for i, x in enumerate(lists):
                bound += x[4]
                if bound >= threshold:
                    pivot = i
                    break
            if pivot < 0:
                break
            unit = lists[pivot][0]
            pivot += 1
            while pivot < len(lists) and lists[pivot][0] == unit:
                pivot += 1
            # the block maxima around the pivot bound its score more closely
            close, end = 0.0, 1 << 60
            for x in lists[:pivot]:
                k = bisect_left(x[5], unit)
                if k < len(x[5]):
                    close += x[6][k]
                    end = min(end, x[5][k])
            if close < threshold:
                # no unit up to the nearest end of a block can do, nor before the next list begins
                nxt = end + 1 if pivot == len(lists) else min(end + 1, lists[pivot][0])
                lists = self._advance(lists, pivot, max(nxt, unit + 1))
                continue
            score = 0.0
            for x in lists[:pivot]:
                if x[0] < unit:
                    x[1] = bisect_left(x[2], unit, x[1])
                    x[0] = x[2][x[1]] if x[1] < len(x[2]) else 1 << 60
                if x[0] == unit:
                    score += x[3][x[1]]
            if score >= threshold:
                found.append(unit)
            lists = self._advance(lists, pivot, unit + 1)
        return found

    @staticmethod
    def _advance(lists: list, moved: int, unit: int) -> list:
        """Skips the first ``moved`` lists to the first unit not before ``unit``; ended lists go."""
        ended = False
        for x in lists[:moved]:
            if x[0] < unit:
                i = x[1] = bisect_left(x[2], unit, x[1])
                if i < len(x[2]):
                    x[0] = x[2][i]
                else:
                    x[0], ended = 1 << 60, True
            elif x[0] == 1 << 60:
                ended = True
        return [x for x in lists if x[0] < 1 << 60] if ended else lists

    def leaks(self, text: str) -> set[int]:
        """Items of which the text repeats at least about a sentence."""
        words = tokens(text)
        # A unit is verified by two own tokens and a stretch over units of an item by more,
        # all in one passage, so only the passages around two different own tokens of an
        # item, less than a passage apart, are asked; this loses none.
        last: dict[int, tuple[int, str]] = {}
        before: dict[int, tuple[int, str]] = {}
        starts: set[int] = set()
        owners = self.owners
        for i, w in enumerate(words):
            for item in owners.get(w, ()):
                seen = last.get(item)
                if seen is not None and seen[1] == w:
                    seen = before.get(item)  # the last token but this one that differs
                elif seen is not None:
                    before[item] = seen
                if seen is not None and i - seen[0] < PASSAGE:
                    starts.update(range(max(0, (i - PASSAGE) // STEP * STEP + STEP), seen[0] + 1, STEP))
                last[item] = (i, w)
        found: set[int] = set()
        for a in sorted(starts):
            bag = Counter(words[a : a + PASSAGE])
            if not self._possible(bag):
                continue
            near: dict[int, list[int]] = defaultdict(list)
            for u in self.search(set(bag)):
                if u not in self.shared and self.item[u] not in found:
                    near[self.item[u]].append(u)
            found |= {item for item, units in near.items() if any(self._verified(u, bag) for u in units) or self._run(units, bag)}
        return found

    def _possible(self, bag: Counter) -> bool:
        """True if the passage has own tokens enough for a unit, or for a stretch over units of an item."""
        mine: Counter = Counter()
        theirs: Counter = Counter()
        for t in bag:
            for u in self.units_of.get(t, ()):
                mine[u] += 1
                if mine[u] >= self.need[u]:
                    return True
            for item in self.owners.get(t, ()):
                theirs[item] += 1
                if theirs[item] >= RUN_OWN:
                    return True
        return False

    def _run(self, units: list[int], bag: Counter) -> bool:
        """True for a stretch over parts of several units of an item, as long as a sentence."""
        hits = [(u, {t: min(c, bag[t]) for t, c in self.words[u].items() if bag[t]}) for u in units]
        words = sum(sum(h.values()) for _, h in hits)
        own = len({t for u, h in hits for t in self.own[u] if t in h})
        return len(units) > 1 and words >= RUN_WORDS and own >= RUN_OWN

    def _verified(self, u: int, bag: Counter) -> bool:
        w = self.words[u]
        hits = {t: min(c, bag[t]) for t, c in w.items()}
        words, of = sum(hits.values()), sum(w.values())
        own = sum(1 for t in self.own[u] if hits.get(t))
        weight = sum(self.idf[t] * c for t, c in hits.items())
        return (
            words >= max(LEAST_WORDS, WORDS * of)
            and own >= max(LEAST_OWN, OWN * len(self.own[u]))
            and weight >= WEIGHT * self.weight[u]
        )


def leaked_items(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Pairs ``(doc_id, item_id)`` of documents and the test items that they repeat.

    Null and blank texts are in no pair; repeated rows count once; other columns are
    ignored. A test set of more than ``MOST_CHARS`` characters is refused, for its
    index must fit in every task; cut it into several and call again.
    """
    size = items.agg(F.coalesce(F.sum(F.length(text)), F.lit(0)).alias("n")).first()["n"]
    if size > MOST_CHARS:
        raise ValueError(f"{size} characters of test items; at most {MOST_CHARS} are indexed at once")
    rows = items.where(F.col(item_id).isNotNull() & F.col(text).isNotNull()).select(item_id, text).distinct().collect()
    shared = docs.sparkSession.sparkContext.broadcast(Index(sorted((int(r[0]), r[1]) for r in rows)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = shared.value
        for pdf in batches:
            out = [(d, i) for d, t in zip(pdf["d"], pdf["t"], strict=True) for i in sorted(index.leaks(t))]
            yield pd.DataFrame(out, columns=[doc_id, item_id])

    texts = docs.select(F.col(doc_id).alias("d"), F.col(text).alias("t")).where(F.col("d").isNotNull() & (F.length(F.trim("t")) > 0))
    return spread(texts).mapInPandas(run, f"{doc_id} long, {item_id} long").distinct()
