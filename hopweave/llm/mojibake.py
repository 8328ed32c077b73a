"""Problem 10: text that was decoded with the wrong character encoding.

Method: a smoothed character trigram model is trained on the clean records of the
corpus itself; every chain "bytes of encoding A read as encoding B" is undone on the
runs of text where it can be, and scored against the original; the likeliest chain of a
record is accepted beyond a margin, which is validated on all clean records when the model
is fitted: they must stay.  Where a chain is accepted, the record's other runs are undone by it
as well, unless they are likelier as they are than the chain is common in the record.

The model is a set of hashed count tables of fixed size, so what the driver holds and
broadcasts does not grow with the corpus; counts and margins cover all clean records.
What the chains of each record gain is found once and written to the shared scratch folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch

# Encodings that text is read with by mistake, and those that it was written in.
READ_AS = ("cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1250", "iso8859-2", "cp1254", "cp1251", "koi8-r", "cp866", "cp855", "mac_cyrillic", "iso8859-5", "cp1253", "cp1257")
#: Written in, read as. UTF-8 may be read as any of ``READ_AS``.
CHAINS = (
    *(("utf-8", wrong) for wrong in READ_AS),
    *((right, wrong) for right in ("cp1251", "koi8-r", "cp866", "mac_cyrillic") for wrong in ("latin-1", "cp1252", "mac_roman", "cp437", "cp850")),
    *((right, wrong) for right in ("cp1251", "koi8-r", "cp866") for wrong in ("cp1251", "koi8-r", "cp866") if right != wrong),
    *((right, wrong) for right in ("shift_jis", "euc_jp", "gb18030", "big5", "euc_kr") for wrong in ("cp1252", "latin-1", "mac_roman", "cp437")),
    *((right, wrong) for right in ("cp1252", "mac_roman", "cp437", "cp850", "cp1250") for wrong in ("cp1252", "mac_roman", "cp437", "cp850", "cp1250") if right != wrong),
    *(("cp1252", wrong) for wrong in ("cp1251", "koi8-r", "cp866")),
    *((right, wrong) for right in ("cp1253", "iso8859-7") for wrong in ("cp1252", "latin-1")),
)
#: Buckets of the hashed count tables of one, two and three characters.
BUCKETS = (1 << 15, 1 << 17, 1 << 18)
#: Weights of the trigram, bigram and single-character estimates; the rest is spread evenly.
W3, W2, W1 = 0.55, 0.3, 0.149
FLOOR = 0.001 / 70_000
#: Natural-log likelihood that a chain must gain in a run, and the least that it must gain in a whole record; UTF-8 is rarely valid by chance, so less is asked there.
RUN_MARGIN, RUN_MARGIN_UTF8, RECORD_MARGIN, RECORD_MARGIN_UTF8 = 4.0, 2.0, 8.5, 5.0
#: Factors of the record margins of which the first is taken that leaves no more than ``FALSE`` of the clean records
#: changed; all that are not ASCII tell, if there are ``LEAST_CLEAN``. What gains more than the last factor asks is garbled, not clean.
FACTORS, FALSE, LEAST_CLEAN = (1.0, 1.3, 1.7, 2.2, 3.0, 5.0), 0.003, 200
#: Natural-log likelihood per character, below which a run is ordinary text and stays (the second: where no two upper characters meet), and that a run may be restored to (the second: from UTF-8).
USUAL, USUAL_SINGLE, RESTORED, RESTORED_UTF8 = 2.2, 2.6, 2.8, 4.0
#: What a character costs that does not fit into a chain.
ODD = 3.0
#: Rounds of undoing: text may be garbled twice.
ROUNDS = 3

_PAIR, _UPPER = regex.compile(r"[^\x00-\x7f]{2}"), regex.compile(r"[^\x00-\x7f]")
#: Encodings whose letters take, or whose words have, several bytes of the upper half.
_WIDE = frozenset(("shift_jis", "euc_jp", "gb18030", "big5", "euc_kr"))
_LONG = _WIDE | {"utf-8", "cp1251", "koi8-r", "cp866", "mac_cyrillic", "cp1253", "iso8859-7"}
_PART = regex.compile(rb"[\x80-\xff]{4}")
#: Four-byte characters of GB 18030 hold ASCII digits.
_GB_FOUR = regex.compile(rb"[\x81-\xfe][0-9][\x81-\xfe][0-9]")
#: By what text was read as: the chains with their numbers.
BY_READING: dict[str, list[tuple[int, str]]] = {}
for _n, (_right, _wrong) in enumerate(CHAINS):
    BY_READING.setdefault(_wrong, []).append((_n, _right))
_GAP = regex.compile(r"[ \t\r\n]+")
#: ASCII punctuation around a run is no part of it.
_RIM = ".,;:!?()\"'"
_RUN = regex.compile(r"[^ \t\r\n]*[^\x00-\x7f][^ \t\r\n]*")
#: What no clean text holds: the replacement character, control characters, and shading and mixed line-drawing.
_NEVER = regex.compile(r"[\x80-\x9f�]")
#: Characters that wrongly read UTF-8 mostly stood for.
_ORDINARY = regex.compile(r"[\x00-\x7f\xa0-ſ‐-›€™−Α-ώЀ-џ、-ヿ一-鿿]*")
_UTF8 = regex.compile(rb"[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}")


def _runs(text: str) -> set[str]:
    return {r.strip(_RIM) for r in _RUN.findall(text)}


@lru_cache(None)
def byte_table(codec: str) -> dict[int, int]:
    """Code point to byte, for the upper half of a one-byte encoding; bytes without a character pass as control characters."""
    table = {}
    for b in range(0x80, 0x100):
        try:
            c = bytes([b]).decode(codec)
        except UnicodeDecodeError:
            c = chr(b)
        table.setdefault(ord(c[0]), b)
    return table


@lru_cache(None)
def _byte_string(codec: str) -> dict[int, str]:
    return {c: chr(b) for c, b in byte_table(codec).items()} | {i: chr(i) for i in range(0x80)}


class _Loose(dict):
    """A translation in which characters without a byte become zero bytes."""

    def __missing__(self, key: int) -> str:
        return "\x00"


@lru_cache(None)
def _loose_bytes(codec: str) -> _Loose:
    return _Loose(_byte_string(codec))


def _as_bytes(run: str, codec: str) -> bytes:
    """The bytes that ``codec`` writes for ``run``, zero for what it has not."""
    return run.translate(_loose_bytes(codec)).encode("latin-1")


@lru_cache(None)
def _stretch(codec: str) -> regex.Pattern:
    """Stretches of text that the encoding can write, with at least one character of its upper half."""
    upper = regex.escape("".join(map(chr, byte_table(codec))))
    return regex.compile(rf"[\x21-\x7e{upper}]*[{upper}][\x21-\x7e{upper}]*")


def undo(run: str, right: str, wrong: str) -> tuple[str, int] | None:
    """``run`` as it was if ``right`` had been read as ``wrong``, and how many characters did not fit in; None if it can't have been."""
    changed, odd = False, 0
    table = _byte_string(wrong)

    def back(m) -> str:
        nonlocal changed, odd
        data = m[0].translate(table).encode("latin-1")
        if right == "utf-8":
            pieces, at, out = 0, 0, []
            # Bytes outside of valid sequences stay the characters they are.
            for u in _UTF8.finditer(data):
                try:
                    c = u[0].decode("utf-8")
                except UnicodeDecodeError:
                    continue
                out += [m[0][at : u.start()], c]
                at = u.end()
                pieces += 1
            if not pieces:
                return m[0]
            changed = True
            text = "".join(out) + m[0][at:]
            odd += sum(b >= 0x80 for b in data) - sum(len(u[0]) for u in _UTF8.finditer(data))
            return text
        try:
            text = data.decode(right)
        except UnicodeDecodeError:
            return m[0]
        changed = changed or text != m[0]
        return text

    text = _stretch(wrong).sub(back, run)
    return (text, odd) if changed else None


#: Multipliers and shifts of the hashes of one, two and three characters.
_ONE, _TWO, _THREE, _MIX = map(np.uint64, (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xBF58476D1CE4E5B9))
_S7, _S13, _S29, _S40 = map(np.uint64, (7, 13, 29, 40))
_MASKS = [np.uint64(n - 1) for n in BUCKETS]


def grams(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket numbers of the single characters, pairs and triples that end at each character after the second."""
    p = points.astype(np.uint64)
    one = p[2:] * _ONE
    two = one ^ (p[1:-1] * _TWO << _S7)
    three = two ^ (p[:-2] * _THREE << _S13)
    return tuple(((h ^ (h >> _S29)) * _MIX >> _S40 & m).astype(np.int64) for h, m in zip((one, two, three), _MASKS))


def _points(text: str) -> np.ndarray:
    """Code points with two blanks around and for any white space, so that words score alike wherever they stand; digits are alike."""
    p = np.frombuffer(f"  {_GAP.sub('  ', text)} ".encode("utf-32-le"), dtype=np.uint32).copy()
    p[(p >= 48) & (p <= 57)] = 48
    return p


class Model:
    """Hashed trigram counts with smoothed scores; ``factor`` widens the record margins."""

    def __init__(self, one: np.ndarray, two: np.ndarray, three: np.ndarray, factor: float = FACTORS[0]):
        self.one, self.two, self.three, self.factor = one, two, three, factor
        self.total = max(1.0, float(one.sum()))
        self._alone = W1 * one / self.total + FLOOR

    def score(self, text: str) -> float:
        return float(self.scores([text])[0])

    def scores(self, texts: list[str]) -> np.ndarray:
        """The natural-log likelihood of each text, all in one pass."""
        if not texts:
            return np.zeros(0)
        pieces = [f"  {_GAP.sub('  ', t)} " for t in texts]
        ends = np.cumsum([len(p) for p in pieces])
        p = np.frombuffer("".join(pieces).encode("utf-32-le"), dtype=np.uint32).copy()
        p[(p >= 48) & (p <= 57)] = 48
        i1, i2, i3 = grams(p)
        # The contexts of a character are the bucket of the one before and of the pair before.
        c1, c2 = np.roll(i1, 1), np.roll(i2, 1)
        blank = grams(np.array([32, 32, 32], dtype=np.uint32))
        c1[0], c2[0] = blank[0][0], blank[1][0]
        starts = np.concatenate(([0], ends[:-1]))
        # Before the first character of a text are two blanks, whatever the text before it ends with.
        c1[starts[1:]], c2[starts[1:]] = blank[0][0], blank[1][0]
        chance = W3 * self.three[i3] / np.maximum(self.two[c2], 1) + W2 * self.two[i2] / np.maximum(self.one[c1], 1) + self._alone[i1]
        sums = np.concatenate(([0.0], np.cumsum(np.log(np.minimum(chance, 1.0), dtype=np.float64))))
        return sums[ends - 2] - sums[starts]


def suspicious(text: str) -> bool:
    """Whether a record must not train the model: some run of it could be undone to letters, or holds what no clean text holds."""
    if text.isascii():
        return False
    if _NEVER.search(text):
        return True
    runs = _RUN.findall(text)
    cyrillic = 0
    for run in runs:
        how = _suspicious_run(run)
        if how == 2:
            return True
        cyrillic += how
    return cyrillic > 0.3 * len(runs)


@lru_cache(100_000)
def _suspicious_run(run: str) -> int:
    """2: surely; 1: by an encoding in which clean Cyrillic words may look so too; 0: not."""
    if regex.search(r"[¡-ÿ]{4}|[─-▟√∫∂∏∑∞≈≠◊]", run):
        return 2
    for wrong in READ_AS:
        # Few encodings make valid sequences of a clean run, so most are done here.
        if not _UTF8.search(_as_bytes(run, wrong)):
            continue
        for stretch in _stretch(wrong).findall(run):
            data = stretch.translate(_byte_string(wrong)).encode("latin-1")
            upper = sum(b >= 0x80 for b in data)
            valid = sum(len(u[0]) for u in _UTF8.finditer(data))
            if valid and valid == upper and _ORDINARY.fullmatch(data.decode("utf-8", "replace")):
                if wrong in ("cp1251", "koi8-r", "cp866", "cp855", "mac_cyrillic", "iso8859-5", "cp1253"):
                    return 1
                return 2
    return 0


def _count_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    tables = [np.zeros(n, dtype=np.int64) for n in BUCKETS]
    clean = 0
    for pdf in batches:
        for text in pdf.iloc[:, 0]:
            if text and not suspicious(text):
                clean += not text.isascii()
                for table, index in zip(tables, grams(_points(text))):
                    np.add.at(table, index, 1)
    for n, table in enumerate((*tables, np.array([clean]))):
        used = np.flatnonzero(table)
        yield pd.DataFrame({"n": np.full(len(used), n, dtype=np.int32), "bucket": used.astype(np.int32), "count": table[used]})


def fitted(documents: DataFrame, text: str = "text") -> tuple[Model, int]:
    """The model over all clean records, with margins not yet validated, and how many clean records are not ASCII. Each task
    sends one bounded table; the driver gets at most ``sum(BUCKETS) + 1`` rows."""
    texts = documents.where(F.col(text).isNotNull()).select(F.col(text).alias("text"))
    counted = texts.mapInPandas(_count_batches, "n int, bucket int, count bigint")
    rows = counted.groupBy("n", "bucket").agg(F.sum("count").alias("count")).toPandas()
    tables = []
    for n, size in enumerate(BUCKETS):
        t = np.zeros(size, dtype=np.float32)
        own = rows[rows["n"] == n]
        t[own["bucket"].to_numpy()] = own["count"].to_numpy()
        tables.append(t)
    return Model(*tables), int(rows.loc[rows["n"] == len(BUCKETS), "count"].sum())


def scored(documents: DataFrame, keep: list[str], text: str, model: Model) -> DataFrame:
    """The columns of ``keep`` and of every row ``__gain``, what its likeliest chain gains in parts of the margin, ``__clean``,
    whether it is a clean record that the least factor would change, and ``__lost``, whether it holds what no clean text holds."""
    shared = documents.sparkSession.sparkContext.broadcast((model.one, model.two, model.three))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(Model(*shared.value))
        for batch in batches:
            texts = ["" if t is None or t.isascii() else t for t in batch.column(batch.num_columns - 1).to_pylist()]
            gains = restorer.gains(texts)
            clean = [g >= FACTORS[0] and not suspicious(t) for t, g in zip(texts, gains)]
            lost = [_NEVER.search(t) is not None for t in texts]
            made = [pa.array(gains, pa.float64()), pa.array(clean, pa.bool_()), pa.array(lost, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], names=[*batch.schema.names[:-1], "__gain", "__clean", "__lost"])

    kinds = [f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in keep]
    return documents.select(*keep, F.col(text).alias("__text")).mapInArrow(run, ", ".join([*kinds, "__gain double", "__clean boolean", "__lost boolean"]))


def validated(gains: DataFrame, clean: int) -> float:
    """The factor of the record margins that leaves clean records as they are, by the ``scored`` rows of all ``clean`` ones."""
    if clean < LEAST_CLEAN:
        return FACTORS[0]
    over = gains.where("__clean").agg(*(F.count(F.when(F.col("__gain") >= f, 1)) for f in FACTORS)).first()
    return next((f for f, n in zip(FACTORS, over) if n - over[-1] <= FALSE * clean), FACTORS[-1])


def train(documents: DataFrame, text: str = "text") -> Model:
    """The model over all clean records, its margins validated on all of them."""
    model, clean = fitted(documents, text)
    model.factor = validated(scored(documents, [], text, model), clean)
    return model


@lru_cache(None)
def _upper(codec: str) -> frozenset[str]:
    return frozenset(map(chr, byte_table(codec)))


class Restorer:
    """Undoes chains in texts as far as the model finds it likelier."""

    #: Runs whose chains are remembered.
    REMEMBERED = 200_000

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[str, tuple[tuple[int, float], ...]] = {}

    def _attempts(self, run: str) -> dict[str, tuple[int, list[int]]]:
        """What the run may have been: text to the characters that did not fit and the chains that lead to it."""
        upper = {c for c in run if c > "\x7f"}
        pair, many = _PAIR.search(run) is not None, len(_UPPER.findall(run)) > 2
        found: dict[str, tuple[int, list[int]]] = {}
        for wrong, chains in BY_READING.items():
            fits = upper & _upper(wrong)
            if not fits:
                continue
            data, whole = _as_bytes(run, wrong), len(fits) == len(upper)
            valid = pair and _UTF8.search(data) is not None
            # A run that the reading has not all characters of was not read by it as a whole; a longer part of it may have been.
            part = not whole and _PART.search(data) is not None
            if not whole and not valid and not part:
                continue
            four = whole and _GB_FOUR.search(data) is not None
            for n, right in chains:
                if right == "gb18030" and four:
                    pass
                elif (right in _LONG and not pair) or (right in _WIDE and right != "gb18030" and not many):
                    continue
                if right == "utf-8":
                    if not valid:
                        continue
                    text, odd = run, 0
                    # Text may have gone through the same wrong reading several times.
                    for _ in range(ROUNDS):
                        made = undo(text, right, wrong)
                        if made is None or made[0] == text:
                            break
                        text, odd = made[0], odd + made[1]
                        found.setdefault(text, (odd, []))[1].append(n)
                    continue
                if whole:
                    try:
                        text = data.decode(right)
                    except UnicodeDecodeError:
                        continue
                elif part and right in _LONG and (made := undo(run, right, wrong)):
                    text = made[0]
                else:
                    continue
                if text != run:
                    found.setdefault(text, (0, []))[1].append(n)
        return found

    def _learn(self, runs: set[str]) -> None:
        """Find for each run the chains that make it likelier, with what they gain; all are scored at once."""
        new = [r for r in runs if r not in self.known]
        if len(self.known) + len(new) > self.REMEMBERED:
            self.known.clear()
            new = list(runs)
        now = self.model.scores(new)
        odd = [(r, x) for r, x in zip(new, now) if -x >= (USUAL if _PAIR.search(r) else USUAL_SINGLE) * (len(r) + 1)]
        self.known.update(dict.fromkeys(new, ()))
        attempts = [(r, x, self._attempts(r)) for r, x in odd]
        texts = list({t for _, _, a in attempts for t in a})
        score = dict(zip(texts, self.model.scores(texts)))
        for run, x, found in attempts:
            best: dict[int, float] = {}
            for text, (lost, chains) in found.items():
                then = score[text]
                gain = float(then - x - ODD * lost)
                for n in chains:
                    utf8 = CHAINS[n][0] == "utf-8"
                    if gain > (RUN_MARGIN_UTF8 if utf8 else RUN_MARGIN) and -then < (RESTORED_UTF8 if utf8 else RESTORED) * (len(text) + 1):
                        best[n] = max(gain, best.get(n, gain))
            self.known[run] = tuple(sorted(best.items()))

    def _best(self, runs: set[str], utf8_only: frozenset[str]) -> tuple[int, float] | None:
        """The likeliest chain of a record and what it gains, in parts of its margin."""
        gains: dict[int, float] = {}
        for run in runs:
            for n, gain in self.known[run]:
                if run not in utf8_only or CHAINS[n][0] == "utf-8":
                    gains[n] = gains.get(n, 0.0) + gain
        if not gains:
            return None
        best = max(gains, key=lambda n: (gains[n], -n))
        return best, gains[best] / (RECORD_MARGIN_UTF8 if CHAINS[best][0] == "utf-8" else RECORD_MARGIN)

    def gains(self, texts: list[str]) -> list[float]:
        """What the likeliest chain of each text gains, in parts of its margin; 0 where there is none."""
        runs = [_runs(t) for t in texts]
        self._learn({r for own in runs for r in own})
        return [found[1] if (found := self._best(own, frozenset())) else 0.0 for own in runs]

    def _undone(self, run: str, n: int) -> list[tuple[str, int]]:
        right, wrong = CHAINS[n]
        out, text, odd = [], run, 0
        for _ in range(ROUNDS if right == "utf-8" else 1):
            made = undo(text, right, wrong)
            if made is None or made[0] == text:
                break
            text, odd = made[0], odd + made[1]
            out.append((text, odd))
        return out

    def _replace(self, chosen: list[tuple[set[str], int]]) -> list[dict[str, str]]:
        """For each record's runs and its chain, the runs to replace."""
        made = [{r: self._undone(r, n) for r in runs} for runs, n in chosen]
        texts = list({t for own in made for r, ways in own.items() for t in (r, *(w for w, _ in ways))})
        score = dict(zip(texts, self.model.scores(texts)))
        out = []
        for own, (_, n) in zip(made, chosen):
            gain = {r: max((score[t] - score[r] - ODD * odd, t) for t, odd in ways) for r, ways in own.items() if ways}
            margin = RUN_MARGIN_UTF8 if CHAINS[n][0] == "utf-8" else RUN_MARGIN
            garbled, clean = sum(g > margin for g, _ in gain.values()), sum(g < -RUN_MARGIN for g, _ in gain.values())
            # How likely any run of this record is garbled, from those that tell surely.
            prior = float(np.log((garbled + 0.5) / (clean + 0.1)))
            out.append({r: t for r, (g, t) in gain.items() if g + max(prior, 0.0) > 0})
        return out

    def restore_all(self, texts: list[str | None]) -> list[tuple[str | None, bool]]:
        """Each text restored, and whether it was garbled; a replacement character is garbled text that can't be restored."""
        now: list[str | None] = list(texts)
        garbled = [False] * len(texts)
        done: list[frozenset[str]] = [frozenset()] * len(texts)
        active = [i for i, t in enumerate(texts) if t and not t.isascii()]
        for _ in range(ROUNDS):
            runs = {i: _runs(now[i]) for i in active}
            self._learn({r for own in runs.values() for r in own})
            chosen = [(i, best[0]) for i in active if (best := self._best(runs[i], done[i])) and best[1] >= self.model.factor]
            if not chosen:
                break
            active = []
            for (i, _), known in zip(chosen, self._replace([(runs[i], n) for i, n in chosen])):
                text = _RUN.sub(lambda m: m[0].replace(core, known[core]) if (core := m[0].strip(_RIM)) in known else m[0], now[i])
                garbled[i] = True
                if text != now[i]:
                    now[i], done[i] = text, done[i] | {x.strip(_RIM) for w in known.values() for x in _RUN.findall(w)}
                    active.append(i)
        return [(t, g or bool(t) and _NEVER.search(t) is not None) for t, g in zip(now, garbled)]

    def restore(self, text: str | None) -> tuple[str | None, bool]:
        return self.restore_all([text])[0]


def restored_text(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``garbled`` and ``restored`` of every row.

    Null texts stay null, empty and ASCII texts are never garbled.  Text that was lost
    (replacement characters) stays as it is and counts as garbled.
    """
    spark = documents.sparkSession
    model, clean = fitted(documents, text)
    gains = Scratch(spark, "encodings").cut(scored(documents, [key, text], text, model))
    model.factor = validated(gains, clean)
    shared = spark.sparkContext.broadcast((model.one, model.two, model.three, model.factor))
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(Model(*shared.value))
        for batch in batches:
            made = restorer.restore_all(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([True] * len(made), pa.bool_()), pa.array([t for t, _ in made], pa.string())], names=[key, "garbled", "restored"])

    # What gains less than the margin stays as it is.
    kept = gains.where(F.col("__gain") < model.factor).select(key, F.col("__lost").alias("garbled"), F.col(text).alias("restored"))
    return kept.union(gains.where(F.col("__gain") >= model.factor).select(key, text).mapInArrow(run, f"`{key}` {kind}, garbled boolean, restored string"))


def garbled_documents(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The keys of rows with text that a wrong encoding has garbled: those that ``restored_text`` calls so, found without restoring them."""
    model, clean = fitted(documents, text)
    rows = scored(documents, [key], text, model).where(F.col("__lost") | (F.col("__gain") >= FACTORS[0]))
    gains = Scratch(documents.sparkSession, "encodings").cut(rows)
    return gains.where(F.col("__lost") | (F.col("__gain") >= validated(gains, clean))).select(key).distinct()
