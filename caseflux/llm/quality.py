"""Problem 9: text statistics of documents, and prose told from the rest.

Gradient-boosted trees are trained on the statistics of weakly labelled prose
and structural junk together with part of the hand-checked labels; the rest of
those calibrates the probabilities (Platt scaling on the margin).  Labelled
rows are a bounded sample; statistics and scores cover every document.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflux.session import Workspace

#: Most hand-labelled, and most weakly labelled, rows used in training.
LABELLED_ROWS = 6000
WEAK_ROWS = 4000
TREES, DEPTH, RATE, BINS = 80, 3, 0.15, 32
# Function words of the languages the texts may be in.
COMMON = frozenset(
    "the of and to in a is that for it was on with as be by at from his had not are but have this an which you or were her all she there would their we him been has when who will more no if out so said what up its about into than them can only other new some could time these two may then do first any my now such like our over even most after also did many before must through years where much your way well down should because each just those people how too little good very make still own see men work long get here between both under never same another know while last might us off come since against go came right used take three "
    "der die das und ist nicht ein eine zu den von mit auf im sich des dem für als auch es an werden aus er hat dass sie nach bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man sein wurde sei wird "
    "le la les des et est un une dans que qui pour pas sur au avec ce il par plus ne se son sont mais ou nous vous elle aux cette été être ont leur deux même ses fait comme "
    "el los las del y una por con para su al lo como más pero sus ya o fue este ha sí porque esta entre cuando muy sin sobre ser tiene también me hasta hay donde han quien están desde todo nos durante "
    "il di che non per una sono del si della con gli da le nel alla più ma come anche dei ed delle era essere questo quando "
    "de van het een en is niet dat op te in zijn met voor er aan als maar om ook dan bij nog naar heeft wordt door uit over "
    "och att det som en på är av för med den till inte har ett om var jag men så från de vid kan "
    "o os as um uma não em do da dos das no na mais foi são pelo pela seu sua também já".split()
)
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
_BULLET = re.compile(r"\s*(?:[-*•·▪◦–—>»#+]|\(?\d{1,3}[.)]|\(?[a-zA-Z][.)]|\d+(?:\.\d+)+|\[[ xX]?\])\s+")
_DELIM = re.compile(r"\t| {3,}|\||;(?=\S)|,(?=\S)")
_SHAPE = re.compile(r"\d+")
_CJK = re.compile("[぀-ヿ㐀-鿿가-힯]")
_STOP = re.compile(r"[.!?…。！？][\"'”’)\]]*(?=\s|$)|[。！？]")
_SHOUT = re.compile(r"\b[A-Z]{2,}\b")
_TITLE = re.compile(r"\b[A-Z]")
_OTHER = re.compile("[\u0250-\u1fff\u2c00-\ufdff]")
_ENDS = (".", "!", "?", "”", '"', "…", ":", "。", ".)")
_LEADER = re.compile(r"\.{4,}|_{4,}|-{4,}|={4,}")
STATISTICS = (
    "n_words", "mean_word_length", "symbol_ratio", "digit_ratio", "punctuated_lines", "common_words", "letter_ratio", "upper_ratio", "longest_word", "words_per_line", "short_lines", "bullet_lines",
    "delimiter_lines", "delimiters_per_word", "distinct_words", "repeated_lines", "repeated_shapes", "top_word_share", "stops_per_word", "words_per_stop", "prose_share", "leader_lines", "title_words", "cjk_ratio", "space_ratio", "other_letters", "top_pair_share",
)


def statistics(text: str | None) -> list[float]:
    """The STATISTICS of one text; all zero for null and blank texts."""
    if not text or not text.strip():
        return [0.0] * len(STATISTICS)
    n = len(text)
    lines = [x for x in text.split("\n") if x.strip()]
    ascii_only = text.isascii()
    cjk = 0 if ascii_only else len(_CJK.findall(text))
    low: list[str] = []
    common = prose = short = bullets = delimited = delims = leaders = ends = 0
    find, known = _WORD.findall, COMMON
    for x in lines:
        lw = find(x.lower())
        low += lw
        k = sum(w in known for w in lw)
        common += k
        parts = x.count(" ") + 1
        d = len(_DELIM.findall(x))
        delims += d
        delimited += d >= 2
        short += parts < 6
        bullet = _BULLET.match(x) is not None
        bullets += bullet
        leaders += ("..." in x or "__" in x or "--" in x or "==" in x) and _LEADER.search(x) is not None
        ends += x.rstrip().endswith(_ENDS)
        # wrapped prose: enough words, mostly letters, few delimiters, function words among them
        if not bullet and (parts >= 6 or cjk and _CJK.search(x)) and d <= 1 + parts // 12:
            if k >= 0.12 * parts and sum(map(len, lw)) >= 0.6 * len(x) or cjk > 0.3 * n:
                prose += len(x)
    letters = sum(map(len, low))
    nw, nl = max(1, len(low)), max(1, len(lines))
    digits = sum(map(text.count, "0123456789"))
    spaces = text.count(" ") + text.count("\n") + text.count("\t")
    symbols = max(0, n - letters - digits - spaces)
    stops = len(_STOP.findall(text))
    counts = Counter(low)
    top_pair = max(Counter(zip(low, low[1:])).values(), default=0)
    top_word = next((c for w, c in counts.most_common(40) if w not in known), 0)
    shapes = {_SHAPE.sub("9", x.strip()[:12]) for x in lines}
    return [
        float(np.log1p(len(low))), letters / nw, symbols / n, digits / n, ends / nl, common / nw, letters / n, len(_SHOUT.findall(text)) / nw, float(np.log1p(max(map(len, text.split())))), float(np.log1p(len(low) / nl)),
        short / nl, bullets / nl, delimited / nl, delims / nw, len(counts) / nw, 1 - len(set(lines)) / nl, 1 - len(shapes) / nl, top_word / nw, stops / nw, float(np.log1p(len(low) / (stops + 1))), prose / n, leaders / nl,
        len(_TITLE.findall(text)) / nw, cjk / n, spaces / n, 0.0 if ascii_only else len(_OTHER.findall(text)) / n, top_pair / nw,
    ]


def weak_label(s: list[float]) -> int | None:
    """1 for what is structurally no prose, 0 for plain prose, None where in doubt."""
    v = dict(zip(STATISTICS, s))
    if v["prose_share"] > 0.85 and v["common_words"] > 0.2 and v["stops_per_word"] > 0.02 and v["top_pair_share"] < 0.08:
        return 0
    if v["prose_share"] < 0.25 and (v["bullet_lines"] > 0.6 or v["delimiter_lines"] > 0.6 or v["common_words"] < 0.06 and v["cjk_ratio"] < 0.1 and v["other_letters"] < 0.2 or v["letter_ratio"] < 0.4 or v["leader_lines"] > 0.5 or v["top_pair_share"] > 0.2):
        return 1
    return None


class BoostedTrees:
    """Binary gradient-boosted trees on histogram bins (logistic loss), with Platt scaling."""

    def __init__(self, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, bins: int = BINS):
        self.n, self.depth, self.rate, self.bins = trees, depth, rate, bins
        self.cuts: list[np.ndarray] = []
        self.trees: list[list[tuple]] = []
        self.base, self.scale, self.shift = 0.0, 1.0, 0.0

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, k], side="right") for k, c in enumerate(self.cuts)], 1)

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> BoostedTrees:
        self.cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, self.bins + 1)[1:-1])) for k in range(x.shape[1])]
        b = self._binned(x)
        p = np.clip(np.average(y, weights=weight), 1e-3, 1 - 1e-3)
        self.base = float(np.log(p / (1 - p)))
        f = np.full(len(y), self.base)
        for _ in range(self.n):
            p = 1 / (1 + np.exp(-f))
            g, h = weight * (y - p), weight * p * (1 - p) + 1e-9
            tree: list[tuple] = []
            f += self.rate * self._grow(tree, b, g, h, np.arange(len(y)), self.depth)
            self.trees.append(tree)
        return self

    def _grow(self, tree: list, b: np.ndarray, g: np.ndarray, h: np.ndarray, rows: np.ndarray, depth: int) -> np.ndarray:
        """Appends the subtree in depth-first order; gives every row's value (0 outside)."""
        out = np.zeros(len(g))
        at = len(tree)
        tree.append(())
        G, H = g[rows].sum(), h[rows].sum()
        best = (1e-6, -1, -1)
        if depth and len(rows) >= 20:
            for k in range(b.shape[1]):
                m = len(self.cuts[k]) + 1
                gs, hs = np.cumsum(np.bincount(b[rows, k], g[rows], m))[:-1], np.cumsum(np.bincount(b[rows, k], h[rows], m))[:-1]
                if len(gs):
                    gain = gs**2 / (hs + 1) + (G - gs) ** 2 / (H - hs + 1) - G**2 / (H + 1)
                    i = int(gain.argmax())
                    if gain[i] > best[0]:
                        best = (float(gain[i]), k, i)
        if best[1] < 0:
            tree[at] = (-1, 0.0, float(G / (H + 1)), -1)
            out[rows] = G / (H + 1)
            return out
        _, k, i = best
        left = b[rows, k] <= i
        out += self._grow(tree, b, g, h, rows[left], depth - 1)
        right = len(tree)
        out += self._grow(tree, b, g, h, rows[~left], depth - 1)
        tree[at] = (k, float(self.cuts[k][i]), 0.0, right)
        return out

    def margin(self, x: np.ndarray) -> np.ndarray:
        f = np.full(len(x), self.base)
        for tree in self.trees:
            stack = [(0, np.arange(len(x)))]
            while stack:
                at, rows = stack.pop()
                k, cut, value, right = tree[at]
                if k < 0:
                    f[rows] += self.rate * value
                    continue
                left = x[rows, k] < cut
                stack += [(at + 1, rows[left]), (right, rows[~left])]
        return f

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        """Platt scaling by Newton steps on (scale, shift)."""
        m = self.margin(x)
        t = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((y == 0).sum() + 2))
        w = np.array([1.0, 0.0])
        X = np.stack([m, np.ones_like(m)], 1)
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(X @ w, -30, 30)))
            hess = (X * (p * (1 - p))[:, None]).T @ X + 1e-3 * np.eye(2)
            w = w + np.linalg.solve(hess, X.T @ (t - p) - 1e-3 * (w - np.array([1.0, 0.0])))
        self.scale, self.shift = (float(w[0]), float(w[1])) if np.isfinite(w).all() and w[0] > 0 else (1.0, 0.0)
        return self

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.margin(x) + self.shift, -30, 30)))


def train(labelled: list[tuple[int, list[float], str]], weak: list[list[float]]) -> BoostedTrees | None:
    """A calibrated model; None if there is only one class to learn from.

    A third of the hand-checked rows (by id) is held out for calibration.
    """
    hold = [k % 3 == 0 for k, _, _ in labelled]
    x = [s for (_, s, _), h in zip(labelled, hold) if not h]
    y = [int(kind != "prose") for (_, _, kind), h in zip(labelled, hold) if not h]
    w = [2.0] * len(x)
    for s in weak:
        k = weak_label(s)
        if k is not None:
            x.append(s), y.append(k), w.append(0.5)
    if len(set(y)) < 2:
        return None
    model = BoostedTrees().fit(np.array(x), np.array(y, float), np.array(w))
    hx = [s for (_, s, _), h in zip(labelled, hold) if h]
    hy = np.array([int(kind != "prose") for (_, _, kind), h in zip(labelled, hold) if h], float)
    if len(set(hy.tolist())) == 2:
        model.calibrate(np.array(hx), hy)
    return model


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [statistics(t) for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "stats"])


def text_statistics(documents: DataFrame) -> DataFrame:
    """(doc_id, one column for each of STATISTICS) of every document."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null").mapInArrow(_statistics, "doc_id long, stats array<double>")
    return rows.select("doc_id", *(F.col("stats")[k].alias(c) for k, c in enumerate(STATISTICS)))


def _scored(model: BoostedTrees | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [statistics(t) for t in b.column(1).to_pylist()]
            x = np.array(rows).reshape(len(rows), len(STATISTICS))
            p = model.probability(x) if model else np.array([float(weak_label(r) == 1) for r in rows])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p), pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "p_other", "stats"])

    return run


def fit_quality(documents: DataFrame, labels: DataFrame, labelled_rows: int = LABELLED_ROWS, weak_rows: int = WEAK_ROWS) -> BoostedTrees | None:
    """The model of ``train`` from bounded samples, chosen by the hash of the id."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    hashed = F.xxhash64(F.col("doc_id").cast("long"))
    hand = labels.where("doc_id is not null and kind is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "kind").dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled_rows)
    some = docs.select("doc_id").where("doc_id is not null").orderBy(hashed, "doc_id").limit(weak_rows)
    wanted = some.select("doc_id", F.lit(None).cast("string").alias("kind")).unionByName(hand).groupBy("doc_id").agg(F.max("kind").alias("kind"))
    # at most labelled_rows + weak_rows ids: a bounded side
    rows = docs.join(F.broadcast(wanted), "doc_id").select("doc_id", "text", "kind")
    stats = rows.select("doc_id", "text").mapInArrow(_statistics, "doc_id long, stats array<double>").join(F.broadcast(wanted), "doc_id").collect()
    labelled = [(r["doc_id"], r["stats"], r["kind"]) for r in sorted(stats, key=lambda r: r["doc_id"]) if r["kind"] is not None]
    return train(labelled, [r["stats"] for r in sorted(stats, key=lambda r: r["doc_id"])])


def score_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, p_other, stats): probability that a document is no natural prose.

    Null and blank texts have zero statistics and count as no prose; repeated
    rows are scored alike; without labels of two kinds the weak rule decides.
    """
    model = fit_quality(documents, labels)
    read = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    return read.mapInArrow(_scored(model), "doc_id long, p_other double, stats array<double>")
