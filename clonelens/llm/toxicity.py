"""Toxicity by a subsequence string kernel, Nyström landmarks and a linear support vector machine.

A text is cut into units (``strings``): its blank-separated tokens without punctuation, digit spellings read as letters, and
runs of single characters joined, so that spaced, punctuated and inserted-character insults stay comparable. Units are
compared by the gap-weighted subsequence kernel. Landmarks from the training sentences span the Nyström feature space; the
machine is linear there. Since each landmark's kernel is a sum over subsequences, machine and landmarks together are one
weight a subsequence, which is how texts are scored.

A labelled sentence of a toxic text need not hold the insult, so training follows multiple instances: all units of clean
sentences are negative, by the root of the number of sentences that hold them; of each toxic text the unit that the machine
finds most toxic, its witness, is positive, and so is every unit that it takes for toxic, unless clean sentences hold it as
often. Copies of positive units with a symbol put in, left out or doubled are positive too, which is what makes the machine
bear such spellings; the kernel gives them most of the unit's subsequences. The first witnesses come from counts, later ones from the machine of the round before; a text without any unit that
looks toxic drops out, as labels may be wrong. Each round solves the machine over all units: those that violate the margin
join the solver's rows until none does. A text's score is a logistic function of its largest unit margins and of its number
of tokens, since a long text meets chance likenesses more often.

Training reads at most ROWS_A_CLASS labelled rows of each class, one text of each labelled id (of several the greatest);
every text is scored whole. A round whose violating units are not used up after PASSES passes says so by a warning.

Defined results: a null or wordless text gets the score of no unit at all; labels of one id that differ count as toxic;
a null id has the checksum 0; without rows of both classes every score is the toxic share of what is there, or 0;
repeated rows give a row each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import warnings
from dataclasses import dataclass
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import strings
from .common import give_back, materialize, table, text_of

ROWS_A_CLASS = 2000
LANDMARKS = 400
ROUNDS = 3  # of choosing witnesses
PASSES = 12  # over all units in one round, fewer once no unit violates the margin
WORST = 4_000  # violating units that join the solver in one pass; the next pass looks for more
ALTERED_FROM, ALTERED_SHARE = 5, 1.0  # units of so many symbols teach altered copies too, of so much of their weight
RIDGE, COST = 1e-2, 10.0
POSITIVE_SHARE = 0.02  # weight of all positive units beside that of all negative ones
TWICE = 2  # weight of a toxic text beside a clean one in the logistic
RARER = 10  # a positive unit's share of toxic sentences is at least so many times its share of clean ones
LOST = -0.5  # margin of the witness below which a toxic text drops out
SLACK = 0.02  # how far a unit may violate the margin
FILES = 16
MEMO = 250_000
SCORED_BYTES = 2 << 20
TOP = 3
NONE = -1.5
_SPACED = re.compile(r"(?<!\S)(?:\S\s){2,}\S(?!\S)", re.A)
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def distinct_tokens(texts) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(words, row, word): the distinct lower-cased tokens of each row of an Arrow array, as pairs of row and word numbers."""
    import pyarrow.compute as pc

    low = pc.utf8_lower(texts)
    # Trimmed, as Arrow reads past the last row's end for the end of its blanks, and by what lies there may leave them on.
    pieces = pc.utf8_split_whitespace(pc.utf8_rtrim_whitespace(low))
    row = np.repeat(np.arange(len(low)), pc.list_value_length(pieces).to_numpy().astype(np.int64))
    coded = pieces.flatten().dictionary_encode()
    words, word = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy().astype(np.int64)
    more_row, more = [], []
    for k in np.flatnonzero(pc.match_substring_regex(low, r"(?:^|\s)(?:\S\s){2,}\S(?:\s|$)").to_numpy(zero_copy_only=False)).tolist():
        runs = ["".join(run.split()) for run in _SPACED.findall(low[k].as_py())]
        more += runs
        more_row += [k] * len(runs)
    word = np.concatenate([word, len(words) + np.arange(len(more))])
    row, words = np.concatenate([row, np.array(more_row, np.int64)]), words + more
    some = np.fromiter(map(bool, words), bool, len(words))[word]
    pairs = _distinct(row[some] * max(1, len(words)) + word[some])
    return words, pairs // max(1, len(words)), pairs % max(1, len(words))


def units_of(texts) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(units, row, unit): the distinct units of each row of an Arrow array."""
    words, row, word = distinct_tokens(texts)
    m, owner = strings.units_matrix(words, fold=False)
    known: dict[str, int] = {}
    number = np.fromiter((known.setdefault(u, len(known)) for u in strings.as_text(m)), np.int64, len(m))
    units = list(known)
    n = np.bincount(owner, minlength=len(words))
    first = np.cumsum(n) - n
    times = n[word]
    at = np.repeat(first[word] - np.cumsum(times) + times, times) + np.arange(times.sum())
    pairs = _distinct(np.repeat(row, times) * max(1, len(units)) + number[at])
    return units, pairs // max(1, len(units)), pairs % max(1, len(units))


@dataclass
class Model:
    weights: np.ndarray | None  # by subsequence; None: without both classes there is only ``prior``
    bias: float
    logistic: np.ndarray | None
    prior: float

    def margins(self, tokens: list[str]) -> np.ndarray:
        """The largest margin of each token's units."""
        m, owner = strings.units_matrix(tokens)
        out = np.full(len(tokens), NONE, np.float32)
        np.maximum.at(out, owner, strings.margins(m, self.weights, self.bias, NONE))
        return out

    def score(self, seen: np.ndarray) -> np.ndarray:
        """Scores of rows of ``Scorer.top``."""
        if self.logistic is None:
            return np.full(len(seen), self.prior)
        return 1 / (1 + np.exp(-np.clip(seen @ self.logistic[:-1] + self.logistic[-1], -30, 30)))


class Scorer:
    def __init__(self, model: Model):
        self.model, self.memo = model, {}

    def top(self, texts) -> np.ndarray:
        """Rows of the TOP largest margins of distinct tokens and the logarithm of their number."""
        n = len(texts)
        out = np.full((n, TOP + 1), NONE)
        out[:, TOP] = -5.0
        if self.model.weights is None or not n:
            return out
        if len(self.memo) > MEMO:
            self.memo.clear()
        words, row, word = distinct_tokens(texts)
        f = np.fromiter(map(self.memo.get, words, repeat(np.nan)), np.float64, len(words))
        new = np.flatnonzero(np.isnan(f))
        names = [words[i] for i in new.tolist()]
        f[new] = self.model.margins(names)
        self.memo.update(zip(names, f[new].tolist(), strict=True))
        tokens = np.bincount(row, minlength=n)
        have = np.flatnonzero(tokens)
        first, value = (np.cumsum(tokens) - tokens)[have], f[word]
        for k in range(TOP if len(have) else 0):
            most = np.maximum.reduceat(value, first)
            out[have, k] = np.maximum(most, NONE)
            # The first place of each row's largest value is not looked at again.
            at = np.flatnonzero(value == np.repeat(most, tokens[have]))
            value[at[np.unique(row[at], return_index=True)[1]]] = -np.inf
        out[:, TOP] = np.log1p(tokens) - 5
        return out


def svm(x: np.ndarray, y: np.ndarray, c: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Squared-hinge linear machine with bias (last), by Newton steps; ``c`` weighs the rows."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    keep = np.eye(x.shape[1])
    keep[-1, -1] = 1e-3
    for _ in range(rounds):
        active = y * (x @ w) < 1
        xa = x[active] * c[active, None]
        new = np.linalg.solve(keep + xa.T @ x[active], xa.T @ y[active])
        if np.allclose(new, w, atol=1e-8):
            break
        w = new
    return w


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Logistic weights with bias (last), by damped Newton steps on smoothed labels."""
    x = np.hstack([x, np.ones((len(x), 1))])
    n1 = y.sum()
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (len(y) - n1 + 2))
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w)), x.T @ (t - p) - 1e-2 * w)
        w = w + step / max(1.0, np.abs(step).max() / 4)
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit_machine(rows: list[str], y: np.ndarray, c: np.ndarray, marks: strings.Landmarks) -> tuple[np.ndarray, float]:
    """Weights by subsequence and bias of the machine on unit ``rows`` with labels ``y`` and weights ``c``."""
    w = svm(marks.features(strings.as_matrix(rows))[:, :-1].astype(np.float64), y, c)
    return marks.fold(w[:-1]), float(w[-1])


def altered(unit: str) -> list[str]:
    """``unit`` with one of two symbols put in, one left out or doubled, at a third, in the middle and at two thirds."""
    head, body = unit[:1], unit[1:]
    n, out = len(body), []
    if n < ALTERED_FROM:
        return out
    for k in sorted({n // 3, n // 2, 2 * n // 3}):
        put_in = [chr(strings.ZERO + strings.FIRST_LETTER + (ord(body[k]) * 7 + n + shift) % 26) for shift in (0, 13)]
        out += [*(body[:k] + x + body[k:] for x in put_in), body[:k] + body[k + 1 :], body[:k] + body[k] + body[k:]]
    return [head + x[: strings.LONGEST] for x in dict.fromkeys(out)]


def _margins(units: DataFrame, weights: np.ndarray, bias: float) -> DataFrame:
    """``units`` with f, their margins."""
    sent = units.sparkSession.sparkContext.broadcast((weights, bias))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in units.schema)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            f = strings.margins(strings.as_matrix(b.column("unit")), *sent.value, NONE)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(f, pa.float32())], [*b.schema.names, "f"])

    return units.mapInArrow(run, f"{schema}, f float")


def _violators(units: DataFrame, state: tuple[np.ndarray, float], known: dict[str, int]) -> dict[str, int]:
    """The WORST clean units beyond the margin that the solver does not hold yet; none only where there is none."""
    sent = units.sparkSession.sparkContext.broadcast(frozenset(known))

    def unknown(batches):
        import pyarrow as pa

        for b in batches:
            yield b.filter(pa.array([u not in sent.value for u in b.column("unit").to_pylist()], pa.bool_()))

    near = _margins(units.where("c > 0"), *state).where(F.col("f") > SLACK - 1).mapInArrow(unknown, "unit string, c long, can boolean, f float")
    return {r.unit: int(r.c) for r in near.orderBy(F.col("f").desc(), "unit").limit(WORST).collect()}


def learn(units: DataFrame, pairs: DataFrame, landmarks: int = LANDMARKS) -> tuple[np.ndarray, float] | None:
    """units (unit, c, can), pairs (bag, unit, z) of toxic texts and the units that may be positive -> weights and bias.

    ``z`` ranks a bag's units for the first round. None without units of both kinds."""
    n, mean = units.where("c > 0").agg(F.count("*"), F.avg(F.sqrt("c"))).first()
    best = pairs.groupBy("bag").agg(F.max_by("unit", F.struct("z", "unit")).alias("unit"))
    positive = {r.unit: float(r.n) for r in best.groupBy("unit").agg(F.count("*").alias("n")).collect()}
    if not n or not positive:
        return None
    quarter = landmarks // 4
    plain = {r.unit: int(r.c) for r in units.where("c > 0").select("unit", "c").orderBy(F.xxhash64("unit"), "unit").limit(quarter).collect()}
    rows, hard, state, marks = dict(plain), [], None, None
    for turn in range(ROUNDS):
        if turn < 2:  # the second landmarks hold the clean units that the first machine comes nearest to take for toxic
            known = sorted(positive, key=lambda u: (-positive[u], u))[: 2 * quarter]
            marks = strings.Landmarks(strings.as_matrix(list(dict.fromkeys([*known, *plain, *hard]))), RIDGE)
        # Altered copies of a witness share a part of its weight, so that the machine bears gaps and inserted symbols.
        taught = dict(positive)
        for u, k in positive.items():
            copies = [x for x in altered(u) if x not in positive]
            for x in copies:
                taught[x] = taught.get(x, 0.0) + ALTERED_SHARE * k / len(copies)
        for _ in range(PASSES):
            names = [*taught, *rows]
            y = np.repeat([1.0, -1.0], [len(taught), len(rows)])
            weight = np.array([*taught.values(), *np.sqrt(list(rows.values()))])
            weight[y > 0] *= POSITIVE_SHARE * n / weight[y > 0].sum()
            weight[y < 0] /= mean
            state = fit_machine(names, y, COST * weight, marks)
            new = _violators(units, state, rows)
            if not new:
                break
            rows |= new
        else:
            warnings.warn(f"round {turn} of training ended after {PASSES} passes with units beyond the margin left", stacklevel=2)
        clean = [u for u in rows if u not in plain]
        f = strings.margins(strings.as_matrix(clean), *state, NONE) if clean else np.zeros(0)
        hard = [clean[i] for i in np.lexsort((np.array(clean), -f))[:quarter] if f[i] > SLACK - 1]
        met = _margins(units.where("can"), *state).where(F.col("f") > LOST).select("unit", "f").join(pairs, "unit")
        # The witness counts once as such, and each unit that is taken for toxic once.
        top = met.groupBy("bag").agg(F.max_by("unit", F.struct("f", "unit")).alias("unit")).select("unit")
        counts = top.unionByName(met.where("f > 0").select("unit")).groupBy("unit").agg(F.count("*").alias("n"))
        now = {r.unit: float(r.n) for r in counts.collect()}
        if not now or now == positive:
            break
        positive = now
    return state


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", held_out: int = 5, rows_a_class: int = ROWS_A_CLASS) -> Model:
    """Learn from rows whose crc32(id as text) mod ``held_out`` is not 0, at most ``rows_a_class`` of each class."""
    named = labels.select(F.col(id_col).alias("l_id"), F.col(label_col).cast("int").alias("y")).where("y is not null").groupBy("l_id").agg(F.max("y").alias("y"))
    named = named.where(F.crc32(F.coalesce(F.col("l_id").cast("string"), F.lit(""))) % held_out != 0)
    by_hash = lambda y: named.where(F.col("y") == y).orderBy(F.xxhash64("l_id"), "l_id").limit(rows_a_class)
    chosen = by_hash(1).unionByName(by_hash(0))  # at most 2 * rows_a_class rows: a size that is proven
    sample = docs.select(F.col(id_col).alias("l_id"), text_of(text_col).alias("text")).join(F.broadcast(chosen), "l_id")
    sample = materialize(sample.groupBy("l_id", "y").agg(F.max("text").alias("text")), "labelled")
    n1, n0 = sample.agg(F.sum("y"), F.sum(1 - F.col("y"))).first()
    if not n1 or not n0:
        return Model(None, 0.0, None, (n1 or 0) / ((n1 or 0) + (n0 or 0)) if n1 else 0.0)

    def split(batches):
        import pyarrow as pa

        for b in batches:
            for text, y in zip(b.column("text"), b.column("y").to_pylist(), strict=True):
                some = list({x for x in _SENTENCE.split(text.as_py()) if x.strip()})
                if some:
                    yield pa.RecordBatch.from_arrays([pa.array(some, pa.string()), pa.array([y] * len(some), pa.int32())], ["sentence", "y"])

    def portions(batches, column):
        """Parts of about SCORED_BYTES of text; what they took is given back at the end."""
        from .words import buffers, chunks

        for b in batches:
            for a, e in chunks(buffers(b.column(column))[1], SCORED_BYTES):
                yield b.slice(a, e - a)
        give_back()

    def count(batches):
        import pyarrow as pa

        for b in portions(batches, "sentence"):
            units, row, unit = units_of(b.column("sentence"))
            y = b.column("y").to_numpy()[row]
            t, every = np.bincount(unit, y, len(units)).astype(np.int64), np.bincount(unit, minlength=len(units))
            yield pa.RecordBatch.from_arrays([pa.array(units, pa.string()), pa.array(t), pa.array(every - t)], ["unit", "t", "c"])

    def hold(batches):
        import pyarrow as pa

        for b in portions(batches, "text"):
            units, row, unit = units_of(b.column("text"))
            names = pa.array(units, pa.string()).take(pa.array(unit))
            yield pa.RecordBatch.from_arrays([b.column("bag").take(pa.array(row)), names], ["bag", "unit"])

    # A sentence that copies repeat counts once; one of both labels is clean.
    sentences = sample.mapInArrow(split, "sentence string, y int").groupBy("sentence").agg(F.min("y").alias("y"))
    counted = sentences.mapInArrow(count, "unit string, t long, c long").groupBy("unit").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    # Read in every pass, and of a size that the labelled rows bound: few files.
    counted = materialize(counted.coalesce(FILES), "units")
    all_t, all_c = counted.agg(F.sum("t"), F.sum("c")).first()
    can = (F.col("t") > 0) & (F.col("t") * F.lit(float(all_c or 0)) >= RARER * F.col("c") * F.lit(float(all_t or 0)))
    share = F.col("t") / (F.col("t") + F.col("c") + 1)
    z = F.col("t") * F.log(share * F.lit(((all_t or 0) + (all_c or 0)) / max(1, all_t or 0)))
    units = counted.select("unit", "c", can.alias("can"))
    held = sample.where("y = 1").select(F.col("l_id").cast("string").alias("bag"), "text").mapInArrow(hold, "bag string, unit string")
    pairs = materialize(held.join(counted.where(can).select("unit", z.alias("z")), "unit").coalesce(FILES), "bags")
    state = learn(units, pairs)
    if state is None:
        return Model(None, 0.0, None, n1 / (n1 + n0))
    give_back()
    model = Model(*state, None, 0.0)
    seen = score_rows(sample.select("l_id", "y", "text"), model, ("l_id", "y")).select("y", "top").collect()
    seen = seen + [r for r in seen if r.y] * (TWICE - 1)
    model.logistic = logistic(np.array([r.top for r in seen]), np.array([r.y for r in seen], float))
    return model


def score_docs(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Rows (doc, score, top): ``doc`` is the whole row, top what ``Scorer.top`` finds in it."""
    from pyspark.sql import types as T

    sent = docs.sparkSession.sparkContext.broadcast(model)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    schema = T.StructType([*packed.schema, T.StructField("score", T.DoubleType()), T.StructField("top", T.ArrayType(T.DoubleType()))])

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        from .words import buffers, chunks

        scorer = Scorer(sent.value)
        for b in batches:
            text = pc.fill_null(pc.struct_field(b.column("doc"), [text_col]), "")
            tops = [scorer.top(text.slice(a, e - a)) for a, e in chunks(buffers(text)[1], SCORED_BYTES)]
            top = np.concatenate([np.zeros((0, TOP + 1)), *tops])
            yield pa.RecordBatch.from_arrays([b.column("doc"), pa.array(scorer.model.score(top)), pa.array(list(top), pa.list_(pa.float64()))], ["doc", "score", "top"])
        scorer.memo.clear()
        give_back()

    return packed.mapInArrow(run, schema)


def score_rows(docs: DataFrame, model: Model, keep: tuple[str, ...], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` with score double and top array<double> for every row."""
    named = docs.select(*[F.col(c) for c in keep], text_of(text_col).alias("__text"))
    return score_docs(named, model, "__text").select(*[F.col(f"doc.{c}") for c in keep], "score", "top")


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    scored = score_rows(docs, model, ("doc_id",))
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
