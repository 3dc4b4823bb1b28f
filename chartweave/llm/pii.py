"""Personal information in free text.

Method: a linear-chain conditional random field over word-shape features, trained on the driver from a small labelled
table (``pii_labels``) and decoded by Viterbi in numpy batches, without the tokens that can't be on the best path but as
O.  The spans it finds are trimmed and checked by kind.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartweave.llm.pii_labels import FAMILIES, GIVEN, KINDS, labelled_rows

LABELS = ["O", *(f"{b}-{k}" for k in KINDS for b in "BI")]
L = len(LABELS)
AROUND = range(-3, 4)
PAD = 4
TRI = 1 << 14
#: A token may carry one blank at its end, which spares most tokens of blanks.
TOKEN = re.compile(r"[^\W\d_]+ ?|\d+ ?|\n|[^\S\n]+|. ?", re.S)
_TITLES = {"mr", "mrs", "ms", "miss", "dr", "prof", "md", "do", "rn", "np", "phd", "pa", "pharmd", "mbbs", "pgr"}


def plain(word: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", word.lower()) if not unicodedata.combining(c))


def _shape(t: str) -> int:
    """A small class of a token: digits by length, words by case and length, the punctuation that matters by itself."""
    if t.isdecimal():
        return min(len(t), 9)
    if t[0].isalpha():
        n = 0 if len(t) == 1 else 1 if len(t) <= 3 else 2
        return 10 + n + (0 if t.islower() else 3 if t.isupper() else 6 if t[0].isupper() and t[1:].islower() else 9)
    k = "\n.,:;-/()[]@<>+#_'’|&".find(t)
    return 22 + k if k >= 0 else 45


class Features:
    """Features of a token, by its text alone; ``known`` numbers those of training."""

    def __init__(self, known: dict[str, int], words: set[str], given: set[str], family: set[str]):
        self.known, self.words, self.given, self.family = known, words, given, family

    def names(self, t: str) -> list[str]:
        if t == "":
            return ["edge"]
        out = [f"s{_shape(t)}"]
        if t.isdecimal():
            out.append("d" + (t if len(t) <= 3 else t[:2]))
        elif t[0].isalpha():
            w = t.lower()
            p = plain(w)
            out.append("w" + w if w in self.words else "unknown")
            if len(w) > 3:
                out += ["e" + p[-3:], "b" + p[:2]]
            if p in self.given:
                out.append("given")
            if p in self.family:
                out.append("family")
        else:
            out.append("p" + t[0])
        return out

    def numbers(self, t: str) -> list[int]:
        return [self.known[n] for n in self.names(t) if n in self.known]


class Tokens:
    """Texts as token numbers with edges between them; the tables per token grow as new tokens come up."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.plain: dict[str, int] = {"": 0}
        self.list = [""]

    def _number(self, t: str) -> int:
        """Twice the token's number, plus one if it carries a blank; -1 for blanks alone."""
        if t != "\n" and t.isspace():
            return -1
        bare = t[:-1] if t[-1] == " " else t
        blank = bare is not t
        if len(bare) > 3 and bare.isdecimal():  # all that features know of a long number
            bare = bare[:2] + "0" * (min(len(bare), 9) - 2)
        if bare not in self.plain:
            self.plain[bare] = len(self.list)
            self.list.append(bare)
        return 2 * self.plain[bare] + blank

    def read(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Token numbers, start offsets, ends, and which text each belongs to (-1: an edge)."""
        ids, starts, ends, owner = [np.zeros(PAD, np.int64)], [np.zeros(PAD, np.int64)], [np.zeros(PAD, np.int64)], [np.full(PAD, -1)]
        number = self.number
        for k, text in enumerate(texts):
            toks = TOKEN.findall(text)
            if not toks:
                continue
            size = np.fromiter(map(len, toks), np.int64, len(toks))
            end = np.cumsum(size)
            for t in set(toks).difference(number):
                number[t] = self._number(t)
            n = np.fromiter(map(number.__getitem__, toks), np.int64, len(toks))
            keep = n >= 0
            edge = np.zeros(PAD, np.int64)
            ids += [n[keep] >> 1, edge]
            starts += [(end - size)[keep], edge]
            ends += [end[keep] - (n[keep] & 1), edge]
            owner += [np.full(int(keep.sum()), k), np.full(PAD, -1)]
        return tuple(map(np.concatenate, (ids, starts, ends, owner)))


def _tri(shape: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashed class of three neighbouring shapes and the blanks between them."""
    gap = np.zeros(len(shape), np.int64)
    gap[1:] = starts[1:] > ends[:-1]
    s = (shape * 2 + gap).astype(np.uint64)
    out = s * np.uint64(97 * 97)
    out[1:] += s[:-1] * np.uint64(97)
    out[:-1] += s[1:]
    return ((out * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(50)).astype(np.int64)


class Model:
    """``most``: beyond so many distinct tokens, all are forgotten before the next batch is read."""

    def __init__(self, features: Features, weights: np.ndarray, tri: np.ndarray, steps: np.ndarray, most: int = 400_000):
        self.features, self.weights, self.tri, self.steps, self.most = features, weights, tri, steps, most
        #: What a label in place of O can gain in the step to it and in the step from it: beside any label, and beside O.
        self.before = ((steps - steps[:, :1]).max(0), steps[0] - steps[0, 0])
        self.behind = ((steps - steps[:1]).max(1), steps[:, 0] - steps[0, 0])
        self._forget()

    def _forget(self) -> None:
        self.tokens, self.known = Tokens(), 0
        self.rows = np.zeros((0, len(AROUND), L), np.float32)
        self.shapes = np.zeros(0, np.int64)

    def _grow(self) -> None:
        """Adds the rows of new tokens; the numbers given out before stay good."""
        new = self.tokens.list[self.known :]
        if len(self.tokens.list) > len(self.rows):  # room for as many again, so that no row is copied often
            room = 2 * len(self.tokens.list) - len(self.rows)
            self.rows = np.concatenate([self.rows, np.zeros((room, len(AROUND), L), np.float32)])
            self.shapes = np.concatenate([self.shapes, np.zeros(room, np.int64)])
        for i, t in enumerate(new, self.known):
            f = self.features.numbers(t)
            if f:
                self.rows[i] = self.weights[:, f].sum(1)
            self.shapes[i] = _shape(t) if t else 46
        self.known += len(new)

    def open(self, emit: np.ndarray, owner: np.ndarray, rounds: int = 6) -> tuple[np.ndarray, np.ndarray]:
        """Begins and ends of the stretches of tokens that aren't sure to be O.

        Where O leads every label by more than that label can gain in its two steps, O is on the best path whatever stands
        beside it; and what is beside such a token can gain only what is to be gained beside O, which makes more tokens
        sure, round by round.  So the best paths of the stretches, cut there, are those of the whole text.  The slack is for
        rounding.
        """
        # by label first, so that the least over the labels is taken along whole rows; by what is beside: neither, left, right, both sure
        lead = np.subtract(emit[:, 0], emit[:, 1:].T, order="C")
        slack = [(lead - (self.before[i & 1] + self.behind[i >> 1])[1:, None]).min(0) for i in range(4)]
        sure = owner < 0
        left = np.flatnonzero(~sure)
        for _ in range(rounds):
            code = sure[np.maximum(left - 1, 0)] + 2 * sure[np.minimum(left + 1, len(sure) - 1)]
            done = np.choose(code, [x[left] for x in slack]) > 0.01
            if not done.any():
                break
            sure[left[done]] = True
            left = left[~done]
        flips = np.flatnonzero(np.diff(np.concatenate([[0], (~sure).view(np.int8), [0]])))
        return flips[::2], flips[1::2]

    def find(self, texts: list[str]) -> list[list[tuple[int, int, str]]]:
        """``(start, end, kind)`` of every item of each text, in order."""
        if len(self.tokens.list) > self.most:
            self._forget()
        ids, starts, ends, owner = self.tokens.read(texts)
        self._grow()
        n = len(ids)
        emit = self.tri[_tri(self.shapes[ids], starts, ends)].copy()
        for j, o in enumerate(AROUND):
            a, z = max(0, -o), n - max(0, o)
            emit[a:z] += self.rows[ids[a + o : z + o], j]
        path = viterbi(emit, *self.open(emit, owner), self.steps)
        out: list[list[tuple[int, int, str]]] = [[] for _ in texts]
        hits = np.flatnonzero(path)
        i = 0
        while i < len(hits):
            j, kind = i, (path[hits[i]] - 1) // 2
            while j + 1 < len(hits) and hits[j + 1] == hits[j] + 1 and path[hits[j + 1]] == 2 * kind + 2:
                j += 1
            k = int(owner[hits[i]])
            span = checked(texts[k], int(starts[hits[i]]), int(ends[hits[j]]), KINDS[kind])
            if span:
                out[k].append(span)
            i = j + 1
        return out


def viterbi(emit: np.ndarray, begin: np.ndarray, end: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Best labels of all segments at once, longest segments first; a segment begins and ends next to O."""
    path = np.zeros(len(emit), np.int64)
    if not len(begin):
        return path
    order = np.argsort(begin - end, kind="stable")
    begin, size = begin[order], (end - begin)[order]
    longest = int(size[0])
    #: How many segments have a token number t.
    alive = np.searchsorted(-size, -np.arange(longest), "left").tolist()
    back: list[np.ndarray] = [np.zeros(0, np.int8)] * longest
    into = np.ascontiguousarray(steps.T)
    score = emit[begin] + steps[0]
    last = score.copy()
    for t in range(1, longest):
        m = alive[t]
        if m < 100:
            every = score[:m, None, :] + into
            back[t] = every.argmax(2).astype(np.int8)
            score = every.max(2)
        else:  # label by label, along whole rows
            best, back[t] = score[:m, :1] + steps[0], np.zeros((m, L), np.int8)
            for p in range(1, L):
                other = score[:m, p : p + 1] + steps[p]
                better = other > best
                np.copyto(best, other, where=better)
                np.putmask(back[t], better, p)
            score = best
        score += emit[begin[:m] + t]
        last[:m] = score
    now = (last + steps[:, 0]).argmax(1)
    rows = np.arange(len(begin))
    for t in range(longest - 1, -1, -1):
        m = alive[t]
        path[begin[:m] + t] = now[:m]
        if t:
            now[:m] = back[t][rows[:m], now[:m]]
    return path


def checked(text: str, a: int, z: int, kind: str) -> tuple[int, int, str] | None:
    """The span without closing punctuation, brackets and titles; None if it can't be of its kind."""
    first = "+(" if kind == "phone" else ""
    while a < z and not (text[a].isalnum() or text[a] in first):
        a += 1
    while z > a and not (text[z - 1].isalnum() or kind == "phone" and text[z - 1] == ")" and "(" in text[a : z - 1]):
        z -= 1
    if text[a : a + 1] == "(" and ")" not in text[a:z]:
        a += 1
    got = text[a:z]
    digits = sum(c.isdigit() for c in got)
    if kind == "name":
        words = re.findall(r"[^\W\d_]+", got)
        if digits or re.search(r"[^\w\s.,'’-]", got) or any(len(re.findall("[a-z][A-Z]", w)) > 1 for w in words) or not any(len(w) > 1 and w.lower() not in _TITLES for w in words):
            return None
        if m := re.match(r"(?i)(?:mr|mrs|ms|dr|prof)\.?\s+", got):
            a += m.end()
        if m := re.search(r"(?i),?\s+(?:md|do|rn|np|phd|pa-c|pharmd|mbbs)$", text[a:z]):
            z = a + m.start()
    elif kind == "phone" and not 7 <= digits <= 15 or kind == "id" and digits < 6 or kind == "address" and not (digits and " " in got):
        return None
    elif kind == "email" and not re.search(r"@|[(\[{]\s*at\s*[)\]}]|\sat\s", got, re.I):
        return None
    return (a, z, kind) if a < z else None


def train(given: list[str] = (), family: list[str] = (), rows: int = 6500, rounds: int = 11, seed: int = 5) -> Model:
    """Maximum likelihood by Adam over batches; ``given`` and ``family``: name lists that serve as word features."""
    table = labelled_rows(rows, given=list(given), family=list(family))
    texts = [t for _, t, _ in table]
    tokens = Tokens()
    ids, starts, ends, owner = tokens.read(texts)
    gold = np.zeros(len(ids), np.int64)
    for k, (_, _, spans) in enumerate(table):
        mine = np.flatnonzero(owner == k)
        for a, z, kind in spans:
            part = mine[(starts[mine] >= a) & (ends[mine] <= z)]
            gold[part] = 2 * KINDS.index(kind) + 2
            gold[part[:1]] -= 1
    counts = Counter(tokens.list[i].lower() for i, g in zip(ids, gold) if g != LABELS.index("B-name") and g != LABELS.index("I-name"))
    words = {w for w, c in counts.items() if c >= 4 and w[:1].isalpha()}
    gaz_given, gaz_family = {plain(w) for w in (*GIVEN, *given)}, {plain(w) for w in (*FAMILIES, *family)}
    feats = Features({}, words, gaz_given, gaz_family)
    names = Counter(f for t in tokens.list for f in feats.names(t))
    feats.known = {f: i for i, f in enumerate(sorted(names))}
    n_feat = len(feats.known)
    width = 8
    table_of = np.full((len(tokens.list), width), n_feat)
    for i, t in enumerate(tokens.list):
        f = feats.numbers(t)[:width]
        table_of[i, : len(f)] = f
    shape = np.array([_shape(t) if t else 46 for t in tokens.list])[ids]
    tri_of = _tri(shape, starts, ends)
    rng = np.random.default_rng(seed)
    params = [np.zeros((len(AROUND), n_feat + 1, L)), np.zeros((TRI, L)), np.zeros((L, L))]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    bounds = [(m[0], m[-1] + 1) for m in (np.flatnonzero(owner == k) for k in range(len(texts))) if len(m)]
    step, mean, taken = 0, [np.zeros_like(p) for p in params], 0
    for r in range(rounds):
        for pick in np.array_split(rng.permutation(len(bounds)), max(1, len(bounds) // 100)):
            step += 1
            seqs = [bounds[i] for i in pick]
            size = np.array([z - a for a, z in seqs])
            t_max = int(size.max())
            pos = np.array([a for a, _ in seqs])[:, None] + np.arange(t_max)
            mask = np.arange(t_max) < size[:, None]
            pos = np.where(mask, pos, seqs[0][0])
            flat = pos[mask]
            seen, at = np.unique(ids[flat[:, None] + np.array(AROUND)], return_inverse=True)
            at = at.reshape(len(flat), -1)
            feats_of = table_of[seen]
            e = params[1][tri_of[flat]]
            for j in range(len(AROUND)):
                e = e + params[0][j][feats_of].sum(1)[at[:, j]]
            emit = np.zeros((*mask.shape, L))
            emit[mask] = e
            marginal, pairs = _expectations(emit, mask, params[2])
            g_e = marginal[mask]
            y = gold[flat]
            g_e[np.arange(len(y)), y] -= 1
            labels = np.zeros(mask.shape, np.int64)
            labels[mask] = y
            both = mask[:, 1:]
            g_s = pairs
            np.add.at(g_s, (labels[:, :-1][both], labels[:, 1:][both]), -1)
            grads = [np.zeros_like(params[0]), np.zeros_like(params[1]), g_s]
            np.add.at(grads[1], tri_of[flat], g_e)
            for j in range(len(AROUND)):
                by_token = np.zeros((len(seen), L))
                np.add.at(by_token, at[:, j], g_e)
                for c in range(width):
                    np.add.at(grads[0][j], feats_of[:, c], by_token)
            grads[0][:, n_feat] = 0
            for p, g, (m, v) in zip(params, grads, moments):
                g = g / len(seqs) + 2e-5 * p
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= 0.06 * (0.9 ** (r / 3)) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
            if r >= rounds - 4:  # the mean of the later steps is steadier than the last
                taken += 1
                for a, p in zip(mean, params):
                    a += (p - a) / taken
    params = mean
    return Model(feats, params[0][:, :n_feat].astype(np.float32), params[1].astype(np.float32), params[2].astype(np.float32))


def _expectations(emit: np.ndarray, mask: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of the labels and expected counts of steps, by forward-backward with rescaling."""
    b, t_max, _ = emit.shape
    w = np.exp(emit - emit.max(2, keepdims=True))
    k = np.exp(steps)
    fore, scale = np.zeros_like(w), np.ones((b, t_max))
    fore[:, 0] = w[:, 0]
    scale[:, 0] = fore[:, 0].sum(1)
    fore[:, 0] /= scale[:, :1]
    for t in range(1, t_max):
        x = (fore[:, t - 1] @ k) * w[:, t]
        s = x.sum(1)
        x /= s[:, None]
        live = mask[:, t, None]
        fore[:, t] = np.where(live, x, fore[:, t - 1])
        scale[:, t] = np.where(mask[:, t], s, 1)
    rear = np.ones_like(w)
    pairs = np.zeros((L, L))
    for t in range(t_max - 2, -1, -1):
        y = w[:, t + 1] * rear[:, t + 1] / scale[:, t + 1, None]
        live = mask[:, t + 1]
        pairs += (fore[live, t].T @ y[live]) * k
        rear[:, t] = np.where(live[:, None], y @ k.T, rear[:, t + 1])
    return fore * rear, pairs


@functools.lru_cache(maxsize=2)
def _trained(given: tuple[str, ...], family: tuple[str, ...]) -> Model:
    return train(list(given), list(family))


def model_for(roster: DataFrame) -> Model:
    """Trained with all distinct given and family names of a roster as word features.  They are held by the driver and in the
    broadcast model, so these grow with the number of distinct names (not with the texts)."""
    given, family = (tuple(sorted(r[0] for r in roster.select(c).distinct().collect() if r[0])) for c in ("given_name", "family_name"))
    return _trained(given, family)


def _share(spark: SparkSession, model: Model):
    f = model.features
    return spark.sparkContext.broadcast((f.known, f.words, f.given, f.family, model.weights, model.tri, model.steps))


def _unpack(parts) -> Model:
    return Model(Features(*parts[:4]), *parts[4:])


def _parts(batch: pa.RecordBatch, fields: list[str], most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about ``most`` bytes of text: many texts are decoded side by side, long ones don't pile up."""
    sizes = sum(pc.fill_null(pc.binary_length(batch.column(j)), 0).to_numpy(zero_copy_only=False).astype(np.int64) for j in range(1, len(fields) + 1))
    total, lo = np.cumsum(sizes), 0
    while lo < batch.num_rows:
        before = total[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(total, before + most, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def find_items(spark: SparkSession, df: DataFrame, key: str, fields: list[str], roster: DataFrame) -> DataFrame:
    """``(key, field_name, kind, char_start, char_end)`` of every item in the named text fields.

    Null, empty and blank fields give no row.  Whole texts are read, whatever their length; repeated field values of a
    batch are read once.  The model (about 2 MB by the labelled table, and the roster's distinct names) is broadcast.
    """
    shared = _share(spark, model_for(roster))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _unpack(shared.value)
        for b in batches:
            for part in _parts(b, fields):
                keys = part.column(0)
                index, names, kinds, a, z = [], [], [], [], []
                for j, field in enumerate(fields, 1):
                    values = part.column(j).to_pylist()
                    distinct = list(dict.fromkeys(v for v in values if v and not v.isspace()))
                    found = dict(zip(distinct, model.find(distinct)))
                    for i, v in enumerate(values):
                        for s, e, kind in found.get(v, ()):
                            index.append(i)
                            names.append(field)
                            kinds.append(kind)
                            a.append(s)
                            z.append(e)
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(index, pa.int64())), pa.array(names, pa.string()), pa.array(kinds, pa.string()), pa.array(a, pa.int64()), pa.array(z, pa.int64())], names=[key, "field_name", "kind", "char_start", "char_end"])

    return df.select(key, *fields).mapInArrow(run, f"{key} {df.schema[key].dataType.simpleString()}, field_name string, kind string, char_start long, char_end long")


def redact(text: str | None, items: list[tuple[int, int, str]]) -> str | None:
    """The text with ``[KIND]`` in place of each item; null stays null."""
    if text is None:
        return None
    out, at = [], 0
    for a, z, kind in sorted(items):
        out += [text[at:a], f"[{kind.upper()}]"]
        at = z
    return "".join(out) + text[at:]


def redacted(spark: SparkSession, df: DataFrame, key: str, fields: list[str], roster: DataFrame) -> DataFrame:
    """The key and the fields, each item in them replaced by its typed placeholder; no row is lost."""
    shared = _share(spark, model_for(roster))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _unpack(shared.value)
        for b in batches:
            cols = [b.column(0)]
            for j, _ in enumerate(fields, 1):
                values = b.column(j).to_pylist()
                found = model.find([v or "" for v in values])
                cols.append(pa.array([redact(v, s) for v, s in zip(values, found)], pa.string()))
            yield pa.RecordBatch.from_arrays(cols, names=[key, *fields])

    return df.select(key, *fields).mapInArrow(run, ", ".join([f"{key} {df.schema[key].dataType.simpleString()}", *(f"{f} string" for f in fields)]))
