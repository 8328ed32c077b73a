"""What texts of a corpus tell about languages and sentences: models for judging short replies.

* A language is known by smoothed character trigrams of the running (lower-case) words of
  the documents that bear its code.  A text whose words fit the question's language much
  worse than that language's own words do is in another one, whichever that is.
* A word speaks for a sentence if running text uses it often and names hardly hold it.

All documents and names count.  Counts are kept in hashed tables of fixed size, so what
the driver holds and broadcasts does not grow with the corpus.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fold import plain
from .mojibake import _points, grams

#: Languages that are modelled: those of most documents, with at least so many. Buckets of one, two and three characters, and of words.
LANGUAGES, LEAST_DOCUMENTS = 40, 20
SIZES, WORDS = (1 << 13, 1 << 15, 1 << 16), 1 << 17
W3, W2, W1, FLOOR = 0.6, 0.3, 0.099, 0.001 / 70_000
#: A word speaks for a sentence from so many uses on, and this many of them for each within a name.
LEAST_USES, BEYOND_NAMES = 6, 8.0
#: Natural-log likelihood per character that a text in another language lacks against what the question's language usually has, and against another known one.
STRANGE, OTHER, SCATTER, UNSEEN = 1.3, 0.25, 6.0, 0.6
_TABLE = "which string, language string, bucket int, n bigint"
_WORD = regex.compile(r"[\p{L}\p{M}]+(?:['’][\p{L}\p{M}]+)*")
_CODE = regex.compile(r"[a-z]{2,3}")


def code(language: str | None) -> str | None:
    """A language code in its plain form; None where it names no language."""
    c = (language or "").strip().casefold().split("-")[0].split("_")[0]
    return c if _CODE.fullmatch(c) and c not in ("und", "mul", "zxx", "mis") else None


def bucket(word: str) -> int:
    return zlib.crc32(word.encode("utf-8")) % WORDS


def running(text: str) -> list[str]:
    """The words of ``text`` that are no names: those that do not begin with a capital letter."""
    return [w for w in _WORD.findall(text) if not w[0].isupper() and not w[0].istitle()]


def _numbers(words: str) -> list[np.ndarray]:
    return [g & (n - 1) for g, n in zip(grams(_points(words)), SIZES)]


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    shapes: dict[str, list[np.ndarray]] = {}
    uses = np.zeros(WORDS, dtype=np.int64)
    documents: dict[str, int] = {}
    for pdf in batches:
        for text, language in zip(pdf.text, pdf.lang):
            if not text:
                continue
            text = plain(text)
            lang = code(language)
            if lang:
                documents[lang] = documents.get(lang, 0) + 1
                tables = shapes.setdefault(lang, [np.zeros(n, dtype=np.int64) for n in SIZES])
                for table, index in zip(tables, _numbers(" ".join(running(text)))):
                    np.add.at(table, index, 1)
            for w in running(text):
                uses[bucket(w.replace("’", "'"))] += 1
    rows = []
    at = np.flatnonzero(uses)
    rows.append(pd.DataFrame({"which": "uses", "language": "", "bucket": at.astype(np.int32), "n": uses[at]}))
    for lang, tables in shapes.items():
        rows.append(pd.DataFrame({"which": ["documents"], "language": [lang], "bucket": np.array([0], dtype=np.int32), "n": [documents[lang]]}))
        for k, table in enumerate(tables):
            at = np.flatnonzero(table)
            rows.append(pd.DataFrame({"which": f"grams{k}", "language": lang, "bucket": at.astype(np.int32), "n": table[at]}))
    yield pd.concat(rows)


def _count_names(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    inside = np.zeros(WORDS, dtype=np.int64)
    for pdf in batches:
        for name in pdf.iloc[:, 0]:
            for w in set(_WORD.findall(plain(name).casefold())) if name else ():
                inside[bucket(w.replace("’", "'"))] += 1
    at = np.flatnonzero(inside)
    yield pd.DataFrame({"which": "names", "language": "", "bucket": at.astype(np.int32), "n": inside[at]})


class Language:
    """Smoothed character trigrams of one language, with the mean score per character of its own text."""

    def __init__(self, tables: list[np.ndarray]):
        self.one, self.two, self.three = (t.astype(np.float32) for t in tables)
        total = max(1.0, float(self.one.sum()))
        self._alone = W1 * self.one / total + FLOOR
        blank = grams(np.array([32, 32, 32], dtype=np.uint32))
        self._blank = [blank[0] & (SIZES[0] - 1), blank[1] & (SIZES[1] - 1)]

    def score(self, words: str) -> float:
        """Mean natural-log likelihood per character."""
        i1, i2, i3 = _numbers(words)
        c1, c2 = np.concatenate((self._blank[0], i1[:-1])), np.concatenate((self._blank[1], i2[:-1]))
        chance = W3 * np.minimum(self.three[i3] / np.maximum(self.two[c2], 1), 1) + W2 * np.minimum(self.two[i2] / np.maximum(self.one[c1], 1), 1) + self._alone[i1]
        return float(np.log(np.minimum(chance, 1.0)).mean())


class Speech:
    """The trained models; without any documents nothing is strange and no word speaks for a sentence."""

    def __init__(self, languages: dict[str, list[np.ndarray]], telling: np.ndarray, usual: dict[str, float] | None = None):
        self.tables, self.telling = languages, telling
        self.languages = {k: Language(t) for k, t in languages.items()}
        self.usual = usual or {}
        self.fit = lru_cache(50_000)(self._fit)

    def speaks(self, word: str) -> bool:
        """Whether a lower-case word is one that makes a sentence."""
        return self.telling[bucket(word)] > 1

    def unseen(self, words: list[str]) -> float:
        """The share of ``words`` that neither the documents nor names hold."""
        return sum(not self.telling[bucket(w.casefold().replace("’", "'"))] for w in words) / max(1, len(words))

    def _fit(self, words: str) -> dict[str, float]:
        return {k: m.score(words) for k, m in self.languages.items()}

    def strange(self, words: list[str], asked: str) -> bool:
        """Whether running ``words`` fit ``asked`` so badly that they are in another language, known or not."""
        if asked not in self.languages or not words:
            return False
        fits = self.fit(" ".join(words))
        best = max(fits, key=lambda k: fits[k])
        lack = self.usual.get(asked, 0.0) - fits[asked]
        if best != asked and fits[best] - fits[asked] > OTHER + 1 / len(words) and self.usual.get(best, 0.0) - fits[best] < lack:
            return True
        # Few words scatter more. Words that no text holds say as much as ill-fitting ones.
        return lack > STRANGE + SCATTER / len(words) or lack > STRANGE and len(words) >= 5 and self.unseen(words) >= UNSEEN


def train(documents: DataFrame | None, names: DataFrame | None) -> Speech:
    """Models from ``documents`` (``text, lang``) and ``names`` (one column).

    Each task sends one bounded table; the driver gets at most ``LANGUAGES`` tables of
    ``SIZES`` and two of ``WORDS`` counts.
    """
    none = np.zeros(WORDS, dtype=np.uint8)
    if documents is None:
        return Speech({}, none)
    counted = documents.where("text is not null").select("text", "lang").mapInPandas(_count, _TABLE)
    if names is not None:
        counted = counted.unionByName(names.mapInPandas(_count_names, _TABLE))
    rows = counted.groupBy("which", "language", "bucket").agg(F.sum("n").alias("n")).toPandas()
    number = rows[rows["which"] == "documents"].sort_values(["n", "language"], ascending=[False, True])
    kept = list(number[number["n"] >= LEAST_DOCUMENTS]["language"][:LANGUAGES])

    def table(which: str, size: int, language: str = "") -> np.ndarray:
        own = rows[(rows["which"] == which) & (rows["language"] == language)]
        out = np.zeros(size)
        out[own["bucket"].to_numpy()] = own["n"].to_numpy()
        return out

    uses, inside = table("uses", WORDS), table("names", WORDS)
    telling = ((uses > 0) | (inside > 0)).astype(np.uint8) + ((uses >= LEAST_USES) & (uses >= BEYOND_NAMES * inside))
    languages = {k: [table(f"grams{i}", n, k) for i, n in enumerate(SIZES)] for k in kept}
    made = Speech(languages, telling)
    made.usual = {k: _usual(m) for k, m in made.languages.items()}
    return made


def _usual(m: Language) -> float:
    """The expected score per character of a language's own text, from its trigram counts.

    Every bucket of three characters holds, up to collisions, one trigram; its pair's and single counts are
    not known, so the entropy of the trigrams given all pairs stands in for the mean score.
    """
    three, two = m.three[m.three > 0], m.two[m.two > 0]
    total = float(three.sum()) or 1.0
    return float((three * np.log(three / total)).sum() / total - (two * np.log(two / float(two.sum() or 1.0))).sum() / float(two.sum() or 1.0))
