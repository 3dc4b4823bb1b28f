"""Texts that were decoded with the wrong character encoding, and their restoration.

Method: records that look intact are garbled by every known chain of encodings, and a multinomial classifier over
hashed byte bigrams learns the chains from them (the counts are summed where the records lie).  It gives each run of
non-ASCII characters the log likelihood ratio of every chain against an intact run.  A chain's case in a record is the
stretch of neighbouring runs with the greatest sum.  Each chain is inverted in its stretch; one by which every byte there
decodes strictly goes before the others, the likelihood of what was there and of what is restored decides among them,
and this is done again until no case is left.  Texts with replacement characters are lost.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: name -> (written as, read as, times): the chains that are known.
CHAINS = {
    "utf8_latin1": ("utf-8", "latin-1", 1),
    "utf8_cp1252": ("utf-8", "cp1252", 1),
    "utf8_cp1252_twice": ("utf-8", "cp1252", 2),
    "utf8_latin1_twice": ("utf-8", "latin-1", 2),
    "utf8_cp1250": ("utf-8", "cp1250", 1),
    "utf8_cp1251": ("utf-8", "cp1251", 1),
    "utf8_mac": ("utf-8", "mac_roman", 1),
    "utf8_cp437": ("utf-8", "cp437", 1),
    "utf8_cp850": ("utf-8", "cp850", 1),
    "cp1251_latin1": ("cp1251", "latin-1", 1),
    "cp1251_cp1252": ("cp1251", "cp1252", 1),
    "koi8_cp1251": ("koi8_r", "cp1251", 1),
    "koi8_cp1252": ("koi8_r", "cp1252", 1),
}
NAMES = ["intact", *CHAINS]
BUCKETS = 1 << 14
#: A run with the ASCII letter before it and the one behind it, if there are any.  Kana, Han and full-width characters are in no
#: code page of a single byte, so they make runs of their own.
_WIDE = r"\u2e80-\ud7ff\uf900-\ufaff\uff00-\uffef"
IN_PLACE = re.compile(rf"(?:(?<=([A-Za-z])))?([{_WIDE}]+|[^\x00-\x7f{_WIDE}]+)(?=([A-Za-z])?)")
LOST = "�"
#: Letters that only these blocks hold: Latin with its supplements, Cyrillic, kana, Han.
LETTERS = [(0xA0, 0x180), (0x400, 0x460), (0x3040, 0x3100), (0x4E00, 0xA000)]
SYMBOLS = [(0x2000, 0x2C00), (0x3000, 0x3040), (0xFE00, 0xFE10), (0xFF00, 0xFFF0), (0x1F000, 0x1FB00)]


@functools.lru_cache(maxsize=None)
def readers(codec: str) -> tuple[list[str], dict[str, int]]:
    """byte -> character and back; bytes that a code page leaves undefined pass through as control characters, and the
    two Western code pages share one way back, as they never disagree about a character."""
    to = [bytes([b]).decode(codec, "ignore") or chr(b) for b in range(256)]
    back = {c: b for b, c in enumerate(to)}
    if codec == "latin-1":
        back |= readers("cp1252")[1]
    elif codec == "cp1252":
        back |= {chr(b): b for b in range(256)}
    return to, back


def garble(text: str, chain: str) -> str | None:
    """The text as the chain leaves it; None if it can't be written that way."""
    written, read, times = CHAINS[chain]
    to, _ = readers(read)
    for _ in range(times):
        try:
            text = text.encode(written).decode("latin-1").translate(dict(enumerate(to)))
        except UnicodeEncodeError:
            return None
    return text


def _features(before: str, run: str, behind: str) -> np.ndarray:
    """Buckets of the byte bigrams of a run; its ends tell whether it stands within a word of ASCII letters."""
    raw = (b"\x03" if before else b"\x01") + run.encode("utf-8", "surrogatepass") + (b"\x04" if behind else b"\x02")
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    return ((b[:-1] * np.uint32(257) + b[1:]) * np.uint32(2654435761)) >> np.uint32(18)


def bigram_counts(records: Iterable[str]) -> np.ndarray:
    """(chain, bucket) counts of records garbled by every chain; the intact ones count in capitals, too, a twentieth each."""
    runs: list[Counter] = [Counter() for _ in NAMES]
    for text in records:
        for k, name in enumerate(NAMES):
            made = text if not k else garble(text, name)
            if made is not None and (not k or made != text):
                runs[k].update(IN_PLACE.findall(made))
        capitals = Counter(IN_PLACE.findall(text.upper()))
        runs[0].update({run: n / 20 for run, n in capitals.items()})
    counts = np.zeros((len(NAMES), BUCKETS))
    for k, found in enumerate(runs):
        for run, n in found.items():
            np.add.at(counts[k], _features(*run), n)
    return counts


class Classifier:
    """Multinomial over hashed byte bigrams of the non-ASCII runs; ``log`` is (chain, bucket)."""

    def __init__(self, log: np.ndarray):
        self.log, self.seen, self.best = log, {}, {}

    @classmethod
    def of(cls, counts: np.ndarray, smooth: float = 0.05) -> Classifier:
        counts = counts + smooth
        return cls(np.log(counts / counts.sum(1, keepdims=True)).astype(np.float32))

    @classmethod
    def train(cls, records: Iterable[str]) -> Classifier:
        return cls.of(bigram_counts(records))

    def likelihoods(self, run: tuple[str, str, str]) -> np.ndarray:
        s = self.seen.get(run)
        if s is None:
            if len(self.seen) > 200_000:
                self.seen.clear()
                self.best.clear()
            s = self.seen[run] = self.log[:, _features(*run)].sum(1, dtype=np.float64)
        return s

    def scores(self, run: tuple[str, str, str]) -> np.ndarray:
        """Log likelihood of each chain, less that of an intact run."""
        s = self.likelihoods(run)
        return s - s[0]

    def intact(self, run: tuple[str, str, str]) -> float:
        return float(self.likelihoods(run)[0]) if run[1] else 0.0

    def suspicious(self, text: str) -> bool:
        """Whether some chain could have a case: none has a greater one than the sum of the best of each run."""
        total = 0.0
        for run in IN_PLACE.findall(text):
            b = self.best.get(run)
            if b is None:
                b = max(0.0, float(self.scores(run)[1:].max()))
                self.best[run] = b
            total += b
        return total >= SURE


def _within(c: int, blocks: list[tuple[int, int]]) -> bool:
    return any(a <= c < z for a, z in blocks)


def _plausible(char: str) -> bool:
    c = ord(char)
    return _within(c, LETTERS) or _within(c, SYMBOLS)


def _undo_utf8(run: str, read: str) -> tuple[str, int]:
    """The run with every sequence of characters whose bytes form the UTF-8 of a plausible character as that character, and how
    many characters stayed although they stand for bytes of such sequences."""
    _, back = readers(read)
    out, left, i = [], 0, 0
    codes = [back.get(c, -1) for c in run]
    while i < len(run):
        b = codes[i]
        n = 2 if 0xC2 <= b < 0xE0 else 3 if 0xE0 <= b < 0xF0 else 4 if 0xF0 <= b < 0xF5 else 0
        part = codes[i : i + n]
        if n and len(part) == n and all(0x80 <= x < 0xC0 for x in part[1:]):
            try:
                c = bytes(part).decode("utf-8")
            except UnicodeDecodeError:
                c = ""
            if c and (_plausible(c) or c in back):  # a text garbled twice has characters of the code page in between
                out.append(c)
                i += n
                continue
        left += b >= 0x80
        out.append(run[i])
        i += 1
    return "".join(out), left


def _undo(run: str, chain: str) -> tuple[str, int]:
    """The run before the chain garbled it, and how many of its characters don't decode strictly."""
    written, read, times = CHAINS[chain]
    if written == "utf-8":
        left = 0
        for _ in range(times):
            run, left = _undo_utf8(run, read)
        return run, left
    _, back = readers(read)
    try:
        made = bytes([back[c] for c in run]).decode(written)
    except (KeyError, UnicodeDecodeError):
        return run, len(run)
    return made, 0


def cases(scores: np.ndarray) -> list[tuple[float, int, int, int]]:
    """``(sum, chain, first run, last run)`` of every chain's stretch of runs with the greatest sum."""
    out = []
    for k in range(1, scores.shape[1]):
        best, now, start = (0.0, k, 0, -1), 0.0, 0
        for i, x in enumerate(scores[:, k]):
            if now <= 0:
                now, start = 0.0, i
            now += x
            if now > best[0]:
                best = (now, k, start, i)
        if best[0] >= SURE:
            out.append(best)
    return out


#: A record has a case from this log likelihood ratio on (prior odds of 1 in 20,000), and what is restored must be as much
#: likelier than what was there to be intact.
SURE = 10.0
#: What a record for training mustn't hold: control characters, the mark of loss, a character that a lead byte is misread as
#: before another that isn't ASCII (but for common letters), a long run of Western letters, or capitals behind a small
#: Cyrillic letter.
LOOKS_GARBLED = r"[\u0080-\u009f�]|[ÂÃÐÑÄÅĂ√∂├┬Γ„‚â][^\x00-\x7fa-zéèêàùûîôçñãõáíóúäöüß]|[À-ÿ]{5}|[а-яё][А-ЯЁ]{2}"


def restore(text: str, classifier: Classifier) -> str | None:
    """The original of a garbled text; None if nothing in it is garbled.

    Each round inverts one chain in one stretch; a text without a case left is done.  UTF-8 sequences only get shorter and a
    text that was there before ends the rounds, so they end.
    """
    now, before = text, {text}
    while True:
        runs = [(m.span(2), (m[1] or "", m[2], m[3] or "")) for m in IN_PLACE.finditer(now)]
        new, most = None, (False, -1.0)
        for score, k, i, j in cases(np.stack([classifier.scores(r) for _, r in runs])) if runs else ():
            out, at, left, gain = [], 0, 0, 0.0
            for (a, z), run in runs[i : j + 1]:
                made, n = _undo(run[1], NAMES[k])
                left += n
                gain += classifier.intact((run[0], made, run[2])) - classifier.intact(run)
                out += [now[at:a], made]
                at = z
            made = "".join(out) + now[at:]
            if made not in before and gain >= SURE and (not left, score + gain) > most:
                new, most = made, (not left, score + gain)
        if new is None:
            return None if now == text else now
        before.add(new)
        now = new


def training_counts(df: DataFrame, key: str, text: str, sample: int) -> np.ndarray:
    """``bigram_counts`` of about ``sample`` records without marks of garbling, the same ones for the same table, all of them if
    there are fewer.  They are chosen by a hash of the key before any text is looked at, and stay where they lie: only counts
    are summed and sent."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((len(NAMES), BUCKETS)), 0
        for b in batches:
            texts = b.column(0).to_pylist()
            n += len(texts)
            total += bigram_counts(texts)
        chain, bucket = np.nonzero(total)
        values = total[chain, bucket]
        yield pa.RecordBatch.from_arrays([pa.array(np.append(chain, -1).astype(np.int32)), pa.array(np.append(bucket, 0).astype(np.int32)), pa.array(np.append(values, n))], names=["chain", "bucket", "n"])

    rows, scale = df.count(), 1 << 30
    share = min(1.0, 2 * sample / max(rows, 1))
    while True:
        chosen = df.where(F.pmod(F.xxhash64(key), F.lit(scale)) < int(share * scale)) if share < 1 else df
        intact = chosen.where(F.col(text).rlike(r"[^\x00-\x7f]") & ~F.col(text).rlike(LOOKS_GARBLED)).select(text)
        summed = intact.mapInArrow(count, "chain int, bucket int, n double").groupBy("chain", "bucket").agg(F.sum("n").alias("n")).toPandas()
        n = summed.n[summed.chain == -1].sum()
        if n >= sample / 2 or share >= 1:
            break
        share = min(1.0, 8 * share)
    out, some = np.zeros((len(NAMES), BUCKETS)), summed[summed.chain >= 0]
    out[some.chain, some.bucket] = some.n
    return out


def garbled_texts(spark: SparkSession, df: DataFrame, key: str, text: str, sample: int = 600) -> DataFrame:
    """``(key, restored_md5)`` of every text of which all or a stretch was decoded wrongly: the lower-case hex MD5 of the
    whole original in UTF-8, or ``lost`` where characters are gone (U+FFFD).

    The classifier is fitted on about ``sample`` whole records, garbled by every chain; all texts are then examined whole.
    Null, empty and ASCII texts give no row.
    """
    model = Classifier.of(training_counts(df, key, text, sample))
    shared = spark.sparkContext.broadcast(model.log)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Classifier(shared.value)
        for b in batches:
            ids, sums = [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if LOST in t:
                    found = "lost"
                elif not model.suspicious(t) or (original := restore(t, model)) is None:
                    continue
                else:
                    found = "lost" if LOST in original else hashlib.md5(original.encode("utf-8", "surrogatepass")).hexdigest()
                ids.append(i)
                sums.append(found)
            yield pa.RecordBatch.from_arrays([pa.array(ids, b.schema.field(0).type), pa.array(sums, pa.string())], names=[key, "restored_md5"])

    rows = df.select(key, text).where(F.col(text).rlike(r"[^\x00-\x7f]"))
    return rows.mapInArrow(run, f"{key} {df.schema[key].dataType.simpleString()}, restored_md5 string")
