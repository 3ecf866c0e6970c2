"""Quality and toxicity classifiers by co-training.

Two views of a document: its text (words, their first four to six letters, the marks around them)
and its page metadata (language, source, length, layout: lines, shares of character classes,
repetition). For each target, quality and toxic, a logistic model of each view is fitted on labelled
documents; over ``rounds`` each view's model labels the pool documents that it is surest of for the
other view, if on held-out labelled documents it is as sure and right at least ``least_precision``
of the time. Both views are then calibrated on the held-out documents and combined.

The classifiers are fitted on the driver on a bounded sample, the only thing that is: at most
``labelled`` labelled and ``pool`` unlabelled documents of the least hashes of their doc_ids (without one, of their texts). The sample and the
order in which it is learnt depend on the rows alone, not on how they are partitioned. Scoring covers every
document's whole text in one pass without a shuffle.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_position, give_back, private_names, small_batches, tidy, values

_CORE = re.compile(r"[^\W\d_]+")
_SLOTS = 1 << 20
LAYOUT = ("bytes", "words", "line words", "word bytes", "distinct words", "most repeated word", "adjacent repeats", "repeated lines",
          "letters", "capitals", "digits", "marks", "symbols", "other bytes", "bars", "stops")
_TARGETS = ("quality", "toxic")


def _slot(kind: str, value: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{kind}\x00{value}") & (_SLOTS - 1)


def token_features(token: str) -> list[int]:
    """Hashed features of a lower-cased token: its letters, their beginnings, and its marks."""
    cores = _CORE.findall(token)
    out = {_slot("m", m) for m in _CORE.split(token) if m}
    for c in cores:
        out.add(_slot("w", c))
        out.update(_slot("p", c[:k]) for k in (4, 5, 6) if len(c) > k)
    return sorted(out)


def tokens(texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct tokens, code of each token, documents' ends): white-space separated, lower case."""
    cut = [t.lower().split() if t else [] for t in texts]
    coded = pa.array([w for c in cut for w in c], pa.string()).dictionary_encode()
    return values(coded.dictionary), coded.indices.to_numpy().astype(np.int64), np.cumsum([len(c) for c in cut])


def layout(text: str | None, codes: np.ndarray) -> list[float]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    n, k = max(1, len(raw)), max(1, len(codes))
    of = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) / n
    lines = raw.split(b"\n")
    found = np.unique(codes, return_counts=True)[1]
    marks = of[33:48].sum() + of[58:65].sum()
    stops = sum(of[ord(c)] for c in ".,;:'-")
    return [math.log1p(len(raw)), math.log1p(len(codes)), math.log1p(k / len(lines)), math.log(n / k), len(found) / k, found.max(initial=0) / k,
            float((codes[1:] == codes[:-1]).sum()) / k, 1 - len(set(lines)) / len(lines), of[97:123].sum(), of[65:91].sum(), of[48:58].sum(), stops,
            marks - stops, of[128:].sum(), of[124], of[46]]


class Logistic:
    """Logistic regression on sparse rows, by AdaGrad with a small L2 pull."""

    def __init__(self, width: int):
        self.w, self.b = np.zeros(width), 0.0

    def fit(self, rows: list[np.ndarray], y: np.ndarray, weight: np.ndarray, epochs: int = 12, rate: float = 0.3, pull: float = 1e-4) -> Logistic:
        size = np.fromiter(map(len, rows), np.int64, len(rows))
        flat, ends = np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64), np.cumsum(size)
        rng, seen, seen_b = np.random.default_rng(3), np.full(len(self.w), 1e-3), 1e-3
        for _ in range(epochs):
            for part in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // 64)):
                n = size[part]
                at = flat[np.arange(n.sum()) + np.repeat(ends[part] - np.cumsum(n), n)]
                row = np.repeat(np.arange(len(part)), n)
                wrong = weight[part] * (1 / (1 + np.exp(-np.clip(np.bincount(row, self.w[at], len(part)) + self.b, -30, 30))) - y[part]) / max(1, len(part))
                cells, inverse = np.unique(at, return_inverse=True)
                g = np.bincount(inverse, wrong[row], len(cells)) + pull * self.w[cells]
                seen[cells] += g * g
                self.w[cells] -= rate * g / np.sqrt(seen[cells])
                gb = wrong.sum()
                seen_b += gb * gb
                self.b -= rate * gb / math.sqrt(seen_b)
        return self

    def logit(self, rows: list[np.ndarray]) -> np.ndarray:
        return np.array([self.w[r].sum() + self.b for r in rows])


def _platt(x: np.ndarray, y: np.ndarray, steps: int = 200) -> np.ndarray:
    """Weights (bias last) of a logistic model of ``y`` on the columns of ``x``, by Newton steps
    towards a prior that leaves the columns as they are. A step that would not lower the loss is
    halved: on classes that the columns part well, whole steps swing about the minimum for good."""
    x = np.column_stack([np.clip(x, -20, 20), np.ones(len(y))])
    prior = np.append(np.full(x.shape[1] - 1, 1 / max(1, x.shape[1] - 1)), 0.0)

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(np.sum(np.logaddexp(0, z) - y * z) + 0.5 * np.sum((w - prior) ** 2))

    w = prior.copy()
    now = loss(w)
    for _ in range(steps):
        p = _sigmoid(x @ w)
        grad = x.T @ (p - y) + (w - prior)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.eye(len(w)), grad)
        while (then := loss(w - step)) > now and np.abs(step).max() >= 1e-10:
            step = step / 2
        if np.abs(step).max() < 1e-8:
            break
        w, now = w - step, then
    return w


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _select(rows: list[np.ndarray], y: np.ndarray, least_z: float = 5.0) -> np.ndarray:
    """Text features whose rate of positives differs from the sample's by ``least_z`` standard
    errors and that at least five documents have: the others would only add noise to long texts."""
    flat = np.concatenate([*rows, np.empty(0, np.int32)]).astype(np.int32)  # each document has a feature once
    cells, n = np.unique(flat, return_counts=True)
    cells, n = cells[n >= 5], n[n >= 5]
    ones, rate = np.zeros(len(cells) + 1), y.mean()
    for r, target in zip(rows, y, strict=True):  # row by row: the driver holds no second copy of the sample
        if target and len(cells):
            at = np.minimum(np.searchsorted(cells, r), len(cells) - 1)
            ones[at[cells[at] == r]] += target
    z = (ones[:-1] - n * rate) / np.sqrt(n * max(rate * (1 - rate), 1e-9))
    return cells[np.abs(z) >= least_z].astype(np.int64)


class View:
    """A view's features, narrowed to those that a target's model uses."""

    def __init__(self, rows: list[np.ndarray], keep: np.ndarray):
        self.keep, self.rows = keep, []
        for r in rows:
            at = np.minimum(np.searchsorted(keep, r), max(0, len(keep) - 1))
            self.rows.append(at[keep[at] == r] if len(keep) else np.empty(0, np.int64))


def co_train(text: list[np.ndarray], meta: list[np.ndarray], y: np.ndarray, rounds: int, least_precision: float, sure: float = 0.98) -> dict | None:
    """Fit one target. ``y``: 1, 0, or nan for the pool. Returns the models, or None if the labels
    have one class only."""
    known = np.flatnonzero(~np.isnan(y))
    if len(known) < 20 or len(np.unique(y[known])) < 2:
        return None
    held, train, pool = known[::4], np.delete(known, np.s_[::4]), np.flatnonzero(np.isnan(y))
    spans = [View(text, _select([text[i] for i in train], y[train])), View(meta, np.unique(np.concatenate([meta[i] for i in train])))]
    own = [(train, y[train]), (train, y[train])]
    models: list[Logistic] = []
    for turn in range(rounds + 1):
        models = []
        for view, (rows, target) in zip(spans, own, strict=True):
            rate = np.clip(target.mean(), 0.02, 0.98)
            weight = np.where(target == 1, 0.5 / rate, 0.5 / (1 - rate)) ** 0.5  # halfway to balance
            models.append(Logistic(len(view.keep)).fit([view.rows[i] for i in rows], target, weight))
        scale = [_platt(m.logit([v.rows[i] for i in held])[:, None], y[held]) for m, v in zip(models, spans, strict=True)]
        if turn == rounds or not len(pool):
            break
        fresh = []
        for m, v, (a, b) in zip(models, spans, scale, strict=True):
            p, check = (_sigmoid(a * m.logit([v.rows[i] for i in part]) + b) for part in (pool, held))
            got = []
            for side in (0.0, 1.0):
                confident, at = np.abs(check - (1 - side)) >= sure, np.abs(p - (1 - side)) >= sure
                if confident.sum() >= 20 and (y[held][confident] == side).mean() >= least_precision:
                    got += [(i, side) for i in pool[at]]
            fresh.append(got)
        own = [(np.concatenate([train, [i for i, _ in got]]).astype(np.int64), np.concatenate([y[train], [s for _, s in got]])) for got in reversed(fresh)]
    logits = np.column_stack([a * m.logit([v.rows[i] for i in held]) + b for m, v, (a, b) in zip(models, spans, scale, strict=True)])
    return {"text": (spans[0].keep, models[0].w, models[0].b, scale[0]), "meta": (spans[1].keep, models[1].w, models[1].b, scale[1]),
            "both": _platt(logits, y[held]), "pseudo": [len(o[0]) - len(train) for o in own]}


def _features(frame: DataFrame) -> DataFrame:
    """Features of sample documents: text (list), layout, lang, source, quality, toxic, and its order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a in range(0, b.num_rows, 500):
                part = b.slice(a, 500)
                texts = part.column(0).to_pylist()
                words, codes, ends = tokens(texts)
                own = [token_features(w) for w in words]
                lists, forms = [], []
                for text, i, j in zip(texts, [0, *ends[:-1]], ends, strict=True):
                    lists.append(sorted({f for c in np.unique(codes[i:j]) for f in own[c]}))
                    forms.append(layout(text, codes[i:j]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lists, pa.list_(pa.int32())), pa.array(forms, pa.list_(pa.float64())), *part.columns[1:]],
                    names=["features", "layout", "lang", "source", "quality", "toxic", "at", "pooled", "doc_id"])

    return frame.select("text", "lang", "source", "quality", "toxic", "at", "pooled", F.col("doc_id").cast("string").alias("doc_id")).mapInArrow(
        tidy(run), "features array<int>, layout array<double>, lang string, source string, quality int, toxic int, at bigint, pooled int, doc_id string")


class Model:
    def __init__(self, sample: pa.Table, rounds: int, least_precision: float):
        lists = sample.column("features").combine_chunks()
        flat, size = lists.flatten().to_numpy(), lists.value_lengths().to_numpy()
        text = np.split(flat, np.cumsum(size)[:-1]) if len(size) else []
        rows = sample.select(["layout", "lang", "source", *_TARGETS]).to_pylist()
        forms = np.array([r["layout"] for r in rows], float).reshape(-1, len(LAYOUT))
        quantiles = [0.005, 0.02, 0.05, *np.arange(0.1, 0.95, 0.1), 0.95, 0.98, 0.995]
        self.cuts = [np.unique(np.quantile(forms[:, i], quantiles)) if len(forms) else np.empty(0) for i in range(len(LAYOUT))]
        meta = [self.meta(f, r["lang"], r["source"]) for f, r in zip(forms, rows, strict=True)]
        self.parts = {}
        for t in _TARGETS:
            y = np.array([math.nan if r[t] is None else float(r[t] > 0) for r in rows])
            self.parts[t] = co_train(text, meta, y, rounds, least_precision)

    def meta(self, form: np.ndarray, lang: str | None, source: str | None) -> np.ndarray:
        """Metadata features: the bin of each layout value, language and source."""
        bins = [i * 64 + int(np.searchsorted(c, x, "right")) for i, (c, x) in enumerate(zip(self.cuts, form, strict=True))]
        named = [len(LAYOUT) * 64 + xxhash.xxh3_64_intdigest(f"{k}={v}") % 512 + 512 * i for i, (k, v) in enumerate((("lang", lang), ("source", source)))]
        return np.array(bins + named, np.int64)

    def weights(self, target: str, view: str) -> tuple[dict[int, float], float]:
        keep, w, b, (scale, shift) = self.parts[target][view]
        return dict(zip(keep.tolist(), (scale * w).tolist(), strict=True)), scale * b + shift


#: Of rows that repeat a doc_id, the one that is learnt from.
_LEAST = "min(struct(text, lang, source)) AS row"


def fit(docs: DataFrame, labels: DataFrame, labelled: int = 6000, pool: int = 6000, rounds: int = 3, least_precision: float = 0.95) -> Model:
    """Fit on at most ``labelled`` + ``pool`` documents. Of several labels of one document the least
    quality and the most toxic count; a null label is none. Documents with a null doc_id, null
    columns and missing ``lang`` or ``source`` columns are fine; without labels all is kept."""
    small_batches(docs.sparkSession)
    have = [c if c in docs.columns else None for c in ("lang", "source")]
    docs = docs.select("doc_id", "text", *(F.col(c).cast("string").alias(n) if c else F.lit(None).cast("string").alias(n) for c, n in zip(have, ("lang", "source"), strict=True)))
    one = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"), F.max("toxic").cast("int").alias("toxic"))
    chosen = one.withColumn("at", F.xxhash64("doc_id")).orderBy("at", "doc_id").limit(labelled)
    known = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "at", "quality", "toxic").agg(F.expr(_LEAST))
    at = F.when(F.col("doc_id").isNull(), F.xxhash64("text", F.lit(7))).otherwise(F.xxhash64("doc_id", F.lit(7)))
    keyed = docs.withColumn("at", at)
    least = keyed.select("doc_id", "at").join(one, "doc_id", "left_anti").distinct().orderBy("at", "doc_id").limit(pool)
    least = F.broadcast(least.select(F.col("doc_id").alias("_id"), F.col("at").alias("_at")))
    free = keyed.join(least, keyed["doc_id"].eqNullSafe(least["_id"]) & (keyed["at"] == least["_at"])).groupBy("doc_id", "at").agg(F.expr(_LEAST))
    free = free.withColumns({"quality": F.lit(None).cast("int"), "toxic": F.lit(None).cast("int")})
    columns = ["doc_id", "at", "quality", "toxic", "row.*"]
    sample = _features(known.select(columns).withColumn("pooled", F.lit(0)).unionByName(free.select(columns).withColumn("pooled", F.lit(1)))).toArrow()
    sample = sample.take(pc.sort_indices(sample, [("pooled", "ascending"), ("at", "ascending"), ("doc_id", "ascending")]))
    model = Model(sample, rounds, least_precision)
    del sample
    give_back()  # the driver goes on to other work
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with the combined probabilities ``p_quality`` and ``p_toxic`` and the calibrated
    ones of each view (text_quality, meta_quality, text_toxic, meta_toxic). Null texts are empty; a
    target that could not be learnt gives quality 1 and toxic 0. Names that ``docs`` has already
    get underscores in front (see :func:`added_names`)."""
    new = added_names(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    at = {c: names.index(c) if c in names else None for c in ("text", "lang", "source")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        plain = {t: {v: m.weights(t, v) for v in ("text", "meta")} for t in _TARGETS if m.parts[t]}
        for whole in batches:
            for a in range(0, whole.num_rows, 1000):
                b = whole.slice(a, 1000)
                get = lambda c: b.column(at[c]).to_pylist() if at[c] is not None else [None] * b.num_rows  # noqa: B023, E731
                texts = get("text")
                words, codes, ends = tokens(texts)
                starts = [0, *ends[:-1]]
                known = {f for t in plain for f in plain[t]["text"][0]}
                used = [[f for f in token_features(w) if f in known] for w in words]
                useful = np.array([bool(u) for u in used], bool)
                out: dict[str, list] = {n: [] for n in new}
                for text, lang, source, i, j in zip(texts, get("lang"), get("source"), starts, ends, strict=True):
                    mine = codes[i:j]
                    features = {f for c in np.unique(mine[useful[mine]]) for f in used[c]} if len(mine) else set()
                    form = m.meta(np.array(layout(text, mine)), lang, source).tolist()
                    for t, (both, own, other) in zip(_TARGETS, (new[:3], new[3:]), strict=True):
                        if t not in plain:
                            for n in (both, own, other):
                                out[n].append(1.0 if t == "quality" else 0.0)
                            continue
                        (w, c), (mw, mc) = plain[t]["text"], plain[t]["meta"]
                        x, z = sum(w.get(f, 0.0) for f in sorted(features)) + c, sum(mw.get(f, 0.0) for f in form) + mc
                        k = m.parts[t]["both"]
                        for n, v in ((both, float(np.clip(x, -20, 20) * k[0] + np.clip(z, -20, 20) * k[1] + k[2])), (own, x), (other, z)):
                            out[n].append(1 / (1 + math.exp(-max(-30.0, min(30.0, v)))))
                yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(out[n], pa.float64()) for n in new)], names=[*names, *new])

    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
    return docs.mapInArrow(tidy(run), ", ".join([*columns, *(f"`{n}` double" for n in new)]))


def added_names(docs: DataFrame) -> tuple[str, ...]:
    return private_names(docs, "p_quality", "text_quality", "meta_quality", "p_toxic", "text_toxic", "meta_toxic")


def keep(docs: DataFrame, labels: DataFrame, least_quality: float = 0.5, most_toxic: float = 0.5, **options) -> DataFrame:
    """The rows of ``docs`` of quality at least ``least_quality`` and toxic below ``most_toxic``, with
    all their columns, whatever their names."""
    inner, named_back = by_position(docs, "doc_id", "text", "lang", "source")
    new = added_names(inner)
    return named_back(score(inner, fit(inner, labels, **options)).where((F.col(new[0]) >= least_quality) & (F.col(new[3]) < most_toxic)).drop(*new))


def digest(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, the six probabilities, and kept."""
    docs = docs.select(*(c for c in ("doc_id", "text", "lang", "source") if c in docs.columns))
    out = score(docs, fit(docs, labels, **options))
    return out.drop("text", "lang", "source").withColumn("kept", (F.col("p_quality") >= 0.5) & (F.col("p_toxic") < 0.5))
