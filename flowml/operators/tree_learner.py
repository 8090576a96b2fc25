"""Deep trees and forests over large tables (H1, H2).

MLlib's learner sends a dense histogram (features x bins x classes) of every node from every
partition. A tree of depth 25 on noisy labels has about as many nodes as rows, so that traffic
grows with the square of the rows. Here only nodes of more than ``LOCAL_ROWS`` rows are split that
way, level by level; the rows of a smaller node are sent to one task once and the whole subtree
below it is grown there. Candidate splits, gains, ties, pruning and the saved form are those
of ``pyspark.ml``: a single tree has the same nodes, and the result is a ``pyspark.ml`` model.

A forest's bootstrap counts are Poisson draws of (seed, row number, tree).
"""

from __future__ import annotations

import json
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowml.session import materialise, scratch_path

#: Rows of a node whose subtree one task grows.
LOCAL_ROWS = 50_000
#: Bytes of histograms that a task holds at once.
HISTOGRAM_BYTES = 64 * 1024 * 1024
#: Numbers of a temporary in the split search.
_ELEMS = 1 << 21
#: MLlib takes a child of less impurity for a leaf.
_EPSILON = 2.0 ** -52

_NODE = ("tree int, key long, left long, right long, depth int, feature int, categories int, "
         "values array<double>, stats array<double>, impurity double, gain double, rows long")
_SAVED = ("treeID int, nodeData struct<id:int,prediction:double,impurity:double,impurityStats:array<double>,"
          "rawCount:bigint,gain:double,leftChild:int,rightChild:int,split:struct<featureIndex:int,"
          "leftCategoriesOrThreshold:array<double>,numCategories:int>>")


# ------------------------------------------------------------------ split search
def _impurity(counts: np.ndarray, total: np.ndarray, kind: str) -> np.ndarray:
    """Of (classes, n) counts, classes added up in order; 0 where nothing is counted."""
    out = np.zeros(counts.shape[1]) if kind == "entropy" else np.where(total == 0, 0.0, 1.0)
    full = np.where(total == 0, 1.0, total)
    for c in counts:
        if kind == "entropy":
            some = np.nonzero(c)[0]
            freq = c[some] / full[some]
            out[some] -= freq * (np.log(freq) / np.log(2.0))
        else:
            out -= (c / full) * (c / full)
    return out


def _gains(left: np.ndarray, whole: np.ndarray, impurity: np.ndarray, kind: str) -> np.ndarray:
    """Gains of splits with ``left`` (classes, n) counts; -inf where a side is empty."""
    right = whole - left
    nl, nr = left.sum(axis=0), right.sum(axis=0)
    n = nl + nr
    gain = impurity - nl / n * _impurity(left, nl, kind) - nr / n * _impurity(right, nr, kind)
    return np.where((nl < 1) | (nr < 1), -np.inf, gain)


def _left_sets(arity: int) -> np.ndarray:
    """(splits, arity): the categories that go left in each split of an unordered feature."""
    numbers = np.arange(1, 1 << (arity - 1))
    return (numbers[:, None] >> np.arange(arity)[None, :]) & 1 == 1


def _category_splits(counts: np.ndarray, whole: np.ndarray, impurity: np.ndarray, spec: dict, f: int):
    """Best split by categories of nodes with (nodes, arity, classes) counts: (gains, left sets)."""
    m, arity, n_classes = counts.shape
    gains, lefts = np.full(m, -np.inf), np.zeros((m, arity), bool)
    if spec["unordered"][f]:
        sets = np.repeat(_left_sets(arity)[None], m, axis=0)
    else:
        # Ordered by impurity, or by the rows of class 1; empty categories last.
        flat = counts.reshape(-1, n_classes).T
        total = flat.sum(axis=0)
        by = _impurity(flat, total, spec["impurity"]) if n_classes > 2 else flat[min(1, n_classes - 1)]
        by = np.where(total == 0, np.finfo(np.float64).max, by)
        order = np.argsort(by.reshape(m, arity), axis=1, kind="stable")
        place = np.argsort(order, axis=1, kind="stable")
        sets = place[:, None, :] <= np.arange(arity - 1)[None, :, None]
    n_splits = sets.shape[1]
    if n_splits == 0:
        return gains, lefts
    left = np.matmul(sets.astype(np.float64), counts).reshape(-1, n_classes).T
    all_gains = _gains(left, np.repeat(whole, n_splits, axis=1), np.repeat(impurity, n_splits),
                       spec["impurity"]).reshape(m, n_splits)
    best = all_gains.argmax(axis=1)
    rows = np.arange(m)
    return all_gains[rows, best], sets[rows, best]


def _best_of_histogram(hist: np.ndarray, spec: dict) -> dict:
    """Best split of one node from its (features, bins, classes) counts."""
    whole = hist[0].sum(axis=0)[:, None]
    impurity = _impurity(whole, whole.sum(axis=0), spec["impurity"])
    best = {"gain": -np.inf, "stats": whole[:, 0], "impurity": float(impurity[0])}
    for f, arity in enumerate(spec["arity"]):
        if arity:
            gain, sets = _category_splits(hist[f][None, :arity], whole, impurity, spec, f)
            if gain[0] > best["gain"]:
                best |= {"gain": float(gain[0]), "feature": f, "bin": -1, "set": sets[0],
                         "left_stats": hist[f][:arity][sets[0]].sum(axis=0)}
            continue
        left = np.cumsum(hist[f], axis=0)[:max(0, len(spec["splits"][f]))].T
        if left.shape[1]:
            gains = _gains(left, np.repeat(whole, left.shape[1], axis=1), np.repeat(impurity, left.shape[1]),
                           spec["impurity"])
            at = int(gains.argmax())
            if gains[at] > best["gain"]:
                best |= {"gain": float(gains[at]), "feature": f, "bin": at, "set": None, "left_stats": left[:, at]}
    return best


# ------------------------------------------------------------------ a subtree in one task
def grow(bins: np.ndarray, y: np.ndarray, w: np.ndarray, depth: int, spec: dict) -> dict:
    """The subtree of rows (``bins`` rows x features, classes ``y``, weights ``w``), all nodes of a
    level at once: rows stay sorted by bin inside their node, per feature."""
    n_features, n_classes, kind = bins.shape[1], spec["classes"], spec["impurity"]
    out = {k: [] for k in ("left", "right", "depth", "feature", "bin", "set", "stats", "impurity", "gain")}
    n, bins = len(y), np.asfortranarray(bins)
    if kind == "entropy" and (w == np.floor(w)).all():
        counted = np.arange(w.sum() + 1)
        spec = spec | {"xlogx": counted * np.log(np.maximum(counted, 1))}
    orders = [np.argsort(bins[:, f], kind="stable").astype(np.int32) for f in range(n_features)]
    node, first, done = np.zeros(n, np.int32), 0, 0           # number of each row's node in the level
    m = 1
    while m:
        stats = np.zeros((n_classes, m))
        live = node >= 0
        np.add.at(stats, (y[live], node[live]), w[live])
        total = stats.sum(axis=0)
        impurity = _impurity(stats, total, kind)
        best = {"gain": np.full(m, -np.inf), "feature": np.full(m, -1), "bin": np.full(m, -1)}
        sets: dict[int, np.ndarray] = {}
        # A pure node is a leaf; so is any at the last level.
        open_ = (np.abs(impurity) >= _EPSILON) if depth < spec["depth"] else np.zeros(m, bool)
        if open_.any():
            keep = live & open_[np.where(live, node, 0)]
            for f in range(n_features):
                o = orders[f]
                o = o[keep[o]]
                nodes = node[o]
                if m > 1:
                    by_node = np.argsort(nodes.astype(np.uint16) if m <= 65_536 else nodes, kind="stable")
                    o, nodes = o[by_node], nodes[by_node]
                orders[f] = o
                if spec["arity"][f]:
                    _try_categories(f, o, nodes, bins, y, w, stats, impurity, open_, spec, best, sets)
                else:
                    _try_thresholds(f, o, nodes, bins, y, w, stats, impurity, spec, best, sets)
        split = best["gain"] > 0
        rank = np.cumsum(split) - 1
        base = first + m
        out["left"].append(np.where(split, base + 2 * rank, -1))
        out["right"].append(np.where(split, base + 2 * rank + 1, -1))
        out["depth"].append(np.full(m, depth))
        out["feature"].append(np.where(split, best["feature"], -1))
        out["bin"].append(np.where(split, best["bin"], -1))
        out["set"] += [sets.get(i) if split[i] else None for i in range(m)]
        out["stats"].append(stats.T)
        # MLlib's mark of a node that was searched and has no valid split.
        out["impurity"].append(np.where(open_ & (best["gain"] < 0), -1.0, impurity))
        out["gain"].append(np.where(split, best["gain"], -1.0))
        # Rows of split nodes go on.
        on = np.nonzero(live & split[np.where(live, node, 0)])[0]
        at, f = node[on], best["feature"][node[on]]
        b = bins[on, f]
        to_left = b <= best["bin"][at]
        by_set = np.nonzero(best["bin"][at] < 0)[0]
        if len(by_set):
            table = np.zeros((m, spec["bins"]), bool)
            for i, s in sets.items():
                table[i, :len(s)] = s
            to_left[by_set] = table[at[by_set], b[by_set]]
        node = np.full(n, -1, np.int32)
        node[on] = 2 * rank[at] + np.where(to_left, 0, 1)
        first, m, depth = base, 2 * int(split.sum()), depth + 1
    joined = {k: np.concatenate(v) for k, v in out.items() if k != "set"}
    return joined | {"set": out["set"]}


def _near_best(left: np.ndarray, whole: np.ndarray, at: np.ndarray, xlogx: np.ndarray) -> np.ndarray:
    """Positions of the splits whose entropy gain, by a table of n log n, is the largest of their node
    but for rounding (1e-9 is far above it): only their gains are computed as pyspark.ml does."""
    right = whole - left
    nl, nr = left.sum(axis=0), right.sum(axis=0)
    about = xlogx[left].sum(axis=0) + xlogx[right].sum(axis=0) - xlogx[nl] - xlogx[nr]
    about = np.where((nl < 1) | (nr < 1), -np.inf, about)
    edge = np.nonzero(np.r_[True, at[1:] != at[:-1]])[0]
    top = np.repeat(np.maximum.reduceat(about, edge), np.diff(np.r_[edge, len(at)]))
    return np.nonzero(about >= top - 1e-9 * (nl + nr))[0]


def _try_thresholds(f, o, nodes, bins, y, w, stats, impurity, spec, best, sets) -> None:
    if not len(o):
        return
    # Runs of rows of one node and bin; a split lies between two runs of a node.
    b, n_classes = bins[o, f], spec["classes"]
    new = np.ones(len(o), bool)
    np.logical_or(nodes[1:] != nodes[:-1], b[1:] != b[:-1], out=new[1:])
    first = np.nonzero(new)[0]
    run_node = nodes[first]
    ends = np.nonzero(run_node[1:] == run_node[:-1])[0]
    if not len(ends):
        return
    run = np.cumsum(new) - 1
    counts = np.bincount(run * n_classes + y[o], w[o], len(first) * n_classes).reshape(-1, n_classes)
    upto = np.concatenate([np.zeros((1, n_classes)), np.cumsum(counts, axis=0)])
    at = run_node[ends]
    left = np.ascontiguousarray((upto[ends + 1] - upto[np.searchsorted(run_node, at)]).T)
    if spec.get("xlogx") is not None:
        near = _near_best(left.astype(np.int64), stats[:, at].astype(np.int64), at, spec["xlogx"])
        ends, at, left = ends[near], at[near], left[:, near]
    gains = _gains(left, stats[:, at], impurity[at], spec["impurity"])
    edge = np.nonzero(np.r_[True, at[1:] != at[:-1]])[0]
    top = np.maximum.reduceat(gains, edge)
    length = np.diff(np.r_[edge, len(at)])
    where = np.minimum.reduceat(np.where(gains == np.repeat(top, length), np.arange(len(at)), len(at)), edge)
    better = top > best["gain"][at[edge]]
    won, place = at[edge][better], where[better]
    best["gain"][won], best["feature"][won], best["bin"][won] = top[better], f, b[first[ends[place]]]
    for i in (set(sets) & set(won.tolist()) if sets else ()):
        del sets[i]


def _try_categories(f, o, nodes, bins, y, w, stats, impurity, open_, spec, best, sets) -> None:
    arity, n_classes = spec["arity"][f], spec["classes"]
    which = np.nonzero(open_)[0]
    step = max(1, _ELEMS // (arity * max(n_classes, len(_left_sets(arity)) if spec["unordered"][f] else arity)
                             * n_classes))
    for s in range(0, len(which), step):
        part = which[s:s + step]
        lo, hi = np.searchsorted(nodes, part[0]), np.searchsorted(nodes, part[-1], "right")
        rows = o[lo:hi]
        at = np.searchsorted(part, nodes[lo:hi])
        flat = (at * arity + bins[rows, f]) * n_classes + y[rows]
        counts = np.bincount(flat, w[rows], len(part) * arity * n_classes).reshape(len(part), arity, n_classes)
        gains, lefts = _category_splits(counts, stats[:, part], impurity[part], spec, f)
        for i in np.nonzero(gains > best["gain"][part])[0]:
            won = int(part[i])
            best["gain"][won], best["feature"][won], best["bin"][won] = gains[i], f, -1
            sets[won] = lefts[i]


# ------------------------------------------------------------------ candidate splits
def thresholds(values: np.ndarray, n_splits: int) -> np.ndarray:
    """Candidate thresholds of a numeric feature: all midpoints, or about equal counts between."""
    distinct, counts = np.unique(values, return_counts=True)
    if len(distinct) - 1 <= n_splits:
        return (distinct[1:] + distinct[:-1]) / 2.0
    stride = len(values) / (n_splits + 1)
    out, seen, target = [], float(counts[0]), stride
    for i in range(1, len(distinct)):
        before, seen = seen, seen + counts[i]
        if abs(before - target) < abs(seen - target):
            out.append((distinct[i - 1] + distinct[i]) / 2.0)
            target += stride
    return np.array(out)


def _arities(data: DataFrame, features: str, width: int) -> list[int]:
    """Categories of each feature by the column's attributes, 0 where it is numeric."""
    out = [0] * width
    attrs = (data.schema[features].metadata or {}).get("ml_attr", {}).get("attrs", {})
    for a in attrs.get("nominal", []):
        out[a["idx"]] = len(a["vals"]) if "vals" in a else a["num_vals"]
    for a in attrs.get("binary", []):
        out[a["idx"]] = 2
    return out


# ------------------------------------------------------------------ rows of a tree
def _draws(row: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """Poisson(1) counts of (seed, row, tree)."""
    with np.errstate(over="ignore"):
        z = row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((seed * 1_000_003 + tree + 1) & (2**64 - 1))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
        z ^= z >> np.uint64(31)
    cdf = np.cumsum(np.exp(-1.0) / np.cumprod(np.r_[1.0, np.arange(1, 20)]))
    return np.searchsorted(cdf, (z >> np.uint64(11)) / 2.0 ** 53, side="right").astype(np.float64)


def _weights(row: np.ndarray, tree: int, spec: dict) -> np.ndarray:
    return _draws(row, tree, spec["seed"]) if spec["bootstrap"] else np.ones(len(row))


def _walk(bins: np.ndarray, top: list[dict]) -> np.ndarray:
    """The node of ``top`` (a tree as far as it stands) that each row is in."""
    at = np.zeros(len(bins), np.int64)
    for i, node in enumerate(top):          # children come after their parent
        if node["left"] >= 0:
            here = np.nonzero(at == i)[0]
            b = bins[here, node["feature"]]
            to_left = b <= node["bin"] if node["set"] is None else node["set"][b]
            at[here] = np.where(to_left, node["left"], node["right"])
    return at


def _columns(pdf: pd.DataFrame, width: int):
    bins = np.frombuffer(b"".join(pdf["bins"]), np.uint8 if width <= 256 else np.uint16).reshape(len(pdf), -1)
    return bins, pdf["y"].to_numpy(np.int64), pdf["row"].to_numpy(np.int64)


# ------------------------------------------------------------------ training
def fit_nodes(data: DataFrame, label: str, features: str, n_classes: int, n_trees: int, bootstrap: bool,
              max_depth: int, max_bins: int, impurity: str, seed: int, local_rows: int | None = None) -> DataFrame:
    """All nodes of the trees as rows (treeID, nodeData), numbered as ``pyspark.ml`` does."""
    local_rows = local_rows or LOCAL_ROWS
    spark = data.sparkSession
    plain = data.select(F.col(label).cast("int").alias("y"), vector_to_array(features).alias("x"))
    n = plain.count()
    width = len(plain.first()["x"])
    arity = _arities(data, features, width)
    n_bins = min(max_bins, n)
    # Thresholds come from max_bins^2 rows (10,000 at least), as in pyspark.ml.
    wanted = max(n_bins * n_bins, 10_000)
    seen = plain.select("x") if n <= wanted else plain.select("x").sample(False, wanted / n, seed)
    sample = np.stack(seen.toPandas()["x"].to_numpy())
    splits = [np.array([]) if a else thresholds(sample[:, f], n_bins - 1) for f, a in enumerate(arity)]
    most = int(np.floor(np.log2(n_bins // 2 + 1) + 1)) if n_classes > 2 else 0
    spec = {"arity": arity, "splits": splits, "classes": n_classes, "impurity": impurity, "depth": max_depth,
            "unordered": [0 < a <= most for a in arity], "bins": max([*arity, *(len(s) + 1 for s in splits)]),
            "seed": seed, "bootstrap": bootstrap}

    def to_bins(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = np.stack(pdf["x"].to_numpy()) if len(pdf) else np.zeros((0, width))
            bins = np.empty(x.shape, np.uint8 if spec["bins"] <= 256 else np.uint16)
            for f in range(width):
                bins[:, f] = x[:, f] if arity[f] else np.searchsorted(splits[f], x[:, f], side="left")
            yield pd.DataFrame({"row": pdf["row"], "y": pdf["y"], "bins": [b.tobytes() for b in bins]})

    rows = materialise(plain.withColumn("row", F.monotonically_increasing_id())
                       .mapInPandas(to_bins, "row long, y int, bins binary"), "tree-rows")
    tops = _split_large(rows, spec, n, n_trees, local_rows)
    local = rows.mapInPandas(_local_rows(spec, tops), "tree int, top int, y int, w double, bins binary")
    groups = sum(t["state"] == "local" for top in tops for t in top)
    local = local.repartition(max(1, min(1_000, 2 * groups)), "tree", "top")

    def subtree(pdf: pd.DataFrame) -> pd.DataFrame:
        bins, y = np.frombuffer(b"".join(pdf["bins"]), np.uint8 if spec["bins"] <= 256 else np.uint16) \
            .reshape(len(pdf), -1), pdf["y"].to_numpy(np.int64)
        tree, top = int(pdf["tree"].iloc[0]), int(pdf["top"].iloc[0])
        got = grow(bins, y, pdf["w"].to_numpy(np.float64), tops[tree][top]["depth"], spec)
        return _rows(tree, top, got, spec)

    small = local.groupBy("tree", "top").applyInPandas(subtree, _NODE)
    large = spark.createDataFrame(_top_rows(tops, spec), _NODE)
    return small.unionByName(large).repartition(n_trees, "tree").groupBy("tree").applyInPandas(_number, _SAVED)


def _split_large(rows: DataFrame, spec: dict, n: int, n_trees: int, local_rows: int) -> list[list[dict]]:
    """The trees as far as their nodes hold more than ``local_rows`` rows, a pass per level."""
    root = {"left": -1, "right": -1, "depth": 0, "state": "open" if n > local_rows else "local"}
    tops = [[dict(root)] for _ in range(n_trees)]
    n_features, per_node = len(spec["arity"]), len(spec["arity"]) * spec["bins"] * spec["classes"] * 8
    at_once = max(1, HISTOGRAM_BYTES // per_node)
    while True:
        todo = [(t, i) for t, top in enumerate(tops) for i, node in enumerate(top) if node["state"] == "open"]
        if not todo:
            return tops
        todo = todo[:at_once]

        def count(batches: Iterator[pd.DataFrame], todo=tuple(todo), tops=tops) -> Iterator[pd.DataFrame]:
            size = n_features * spec["bins"] * spec["classes"]
            hist = np.zeros((len(todo), size))
            offset = np.arange(n_features) * spec["bins"] * spec["classes"]
            for pdf in batches:
                bins, y, row = _columns(pdf, spec["bins"])
                for t in sorted({t for t, _ in todo}):
                    at, w = _walk(bins, tops[t]), _weights(row, t, spec)
                    for j, (tree, i) in enumerate(todo):
                        if tree == t:
                            mine = np.nonzero((at == i) & (w > 0))[0]
                            flat = bins[mine].astype(np.int64) * spec["classes"] + y[mine, None] + offset[None, :]
                            hist[j] += np.bincount(flat.ravel(), np.repeat(w[mine], n_features), size)
            full = [j for j in range(len(todo)) if hist[j].any()]
            yield pd.DataFrame({"job": full, "hist": [hist[j].astype(np.int32).tobytes() for j in full]})

        def best(pdf: pd.DataFrame) -> pd.DataFrame:
            hist = sum(np.frombuffer(h, np.int32).astype(np.float64) for h in pdf["hist"])
            got = _best_of_histogram(hist.reshape(n_features, spec["bins"], spec["classes"]), spec)
            return pd.DataFrame({"job": pdf["job"].iloc[:1], "got": [pickle.dumps(got)]})

        found = rows.mapInPandas(count, "job int, hist binary").groupBy("job").applyInPandas(best, "job int, got binary")
        for r in found.collect():           # one small row a node
            t, i = todo[r.job]
            got = pickle.loads(bytes(r.got))
            _split(tops[t], i, got, spec, local_rows)
        for t, i in todo:                   # no row of the bootstrap is in it
            if tops[t][i]["state"] == "open":
                raise ValueError("a tree has no rows")


def _split(top: list[dict], i: int, got: dict, spec: dict, local_rows: int) -> None:
    node = top[i]
    node |= {"state": "leaf", "stats": got["stats"], "impurity": got["impurity"] if got["gain"] >= 0 else -1.0, "gain": -1.0}
    if not got["gain"] > 0 or node["depth"] >= spec["depth"]:
        return
    node |= {"state": "split", "left": len(top), "right": len(top) + 1, "feature": got["feature"], "bin": got["bin"],
             "set": None if got["set"] is None else np.r_[got["set"], np.zeros(spec["bins"] - len(got["set"]), bool)],
             "gain": got["gain"]}
    for stats in (got["left_stats"], got["stats"] - got["left_stats"]):
        impurity = float(_impurity(stats[:, None], stats[None].sum(axis=1), spec["impurity"])[0])
        child = {"left": -1, "right": -1, "depth": node["depth"] + 1, "stats": stats, "impurity": impurity, "gain": -1.0}
        if abs(impurity) < _EPSILON or child["depth"] >= spec["depth"]:
            child["state"] = "leaf"
        else:
            child["state"] = "open" if stats.sum() > local_rows else "local"
        top.append(child)


def _local_rows(spec: dict, tops: list[list[dict]]):
    """Per tree the drawn rows that lie in a node of few rows."""
    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            bins, _, row = _columns(pdf, spec["bins"])
            for t, top in enumerate(tops):
                here = np.array([node["state"] == "local" for node in top])
                if here.any():
                    at, w = _walk(bins, top), _weights(row, t, spec)
                    mine = np.nonzero(here[at] & (w > 0))[0]
                    yield pd.DataFrame({"tree": np.full(len(mine), t, np.int32), "top": at[mine].astype(np.int32),
                                        "y": pdf["y"].to_numpy()[mine], "w": w[mine],
                                        "bins": pdf["bins"].to_numpy()[mine]})

    return send


# ------------------------------------------------------------------ the saved form
def _values(feature: int, bin_: int, chosen, spec: dict) -> list:
    if feature < 0:
        return []
    if bin_ >= 0:
        return [float(spec["splits"][feature][bin_])]
    return [float(c) for c in np.nonzero(chosen[:spec["arity"][feature]])[0]]


def _rows(tree: int, top: int, got: dict, spec: dict) -> pd.DataFrame:
    n = len(got["left"])
    key = (np.int64(top) << 32) + np.arange(n)
    categories = np.where(got["bin"] >= 0, -1, [spec["arity"][f] if f >= 0 else -1 for f in got["feature"]])
    return pd.DataFrame({
        "tree": tree, "key": key, "left": np.where(got["left"] < 0, -1, (np.int64(top) << 32) + got["left"]),
        "right": np.where(got["right"] < 0, -1, (np.int64(top) << 32) + got["right"]), "depth": got["depth"],
        "feature": got["feature"], "categories": categories,
        "values": [_values(f, b, s, spec) for f, b, s in zip(got["feature"], got["bin"], got["set"])],
        "stats": list(got["stats"]), "impurity": got["impurity"], "gain": got["gain"],
        "rows": got["stats"].sum(axis=1).astype(np.int64)})


def _top_rows(tops: list[list[dict]], spec: dict) -> list[tuple]:
    out = []
    for t, top in enumerate(tops):
        for i, node in enumerate(top):
            if node["state"] == "local":
                continue
            f, b = node.get("feature", -1), node.get("bin", -1)
            child = [-1 if node[s] < 0 else node[s] << 32 for s in ("left", "right")]
            out.append((t, i << 32, *child, node["depth"], f, -1 if f < 0 or b >= 0 else spec["arity"][f],
                        _values(f, b, node.get("set"), spec), [float(v) for v in node["stats"]],
                        float(node["impurity"]), float(node["gain"]), int(node["stats"].sum())))
    return out


def _number(pdf: pd.DataFrame) -> pd.DataFrame:
    """One tree: leaves of one prediction under a node are joined, nodes numbered from the root, left first."""
    pdf = pdf.sort_values("key", ignore_index=True)
    key, depth = pdf["key"].to_numpy(), pdf["depth"].to_numpy()
    child = [np.where(pdf[s] < 0, -1, np.searchsorted(key, pdf[s])) for s in ("left", "right")]
    stats = np.stack(pdf["stats"].to_numpy())
    guess, leaf, size = stats.argmax(axis=1), child[0] < 0, np.ones(len(pdf), np.int64)
    levels = [np.nonzero(depth == d)[0] for d in range(depth.max() + 1)]
    for at in reversed(levels):
        at = at[~leaf[at]]
        a, b = child[0][at], child[1][at]
        same = leaf[a] & leaf[b] & (guess[a] == guess[b])
        # The joined leaf has the children's prediction.
        guess[at[same]] = guess[a[same]]
        leaf[at[same]] = True
        size[at] = np.where(same, 1, 1 + size[a] + size[b])
    number = np.full(len(pdf), -1, np.int64)
    number[depth == 0] = 0
    for at in levels:
        at = at[~leaf[at] & (number[at] >= 0)]
        number[child[0][at]] = number[at] + 1
        number[child[1][at]] = number[at] + 1 + size[child[0][at]]
    rows = np.nonzero(number >= 0)[0]
    rows = rows[np.argsort(number[rows])]
    data = []
    for i, values, st in zip(rows, pdf["values"].to_numpy()[rows], stats[rows]):
        end = leaf[i]
        data.append({"id": int(number[i]), "prediction": float(guess[i]), "impurity": float(pdf.at[i, "impurity"]),
                     "impurityStats": st.tolist(), "rawCount": int(pdf.at[i, "rows"]),
                     "gain": -1.0 if end else float(pdf.at[i, "gain"]),
                     "leftChild": -1 if end else int(number[child[0][i]]),
                     "rightChild": -1 if end else int(number[child[1][i]]),
                     "split": {"featureIndex": -1 if end else int(pdf.at[i, "feature"]),
                               "leftCategoriesOrThreshold": [] if end else [float(v) for v in values],
                               "numCategories": -1 if end else int(pdf.at[i, "categories"])}})
    return pd.DataFrame({"treeID": np.full(len(data), int(pdf["tree"].iloc[0]), np.int32), "nodeData": data})


def can_fit(est) -> bool:
    """Whether the estimator asks for nothing but what is written here."""
    usual = (est.getMinInstancesPerNode() == 1 and est.getMinInfoGain() == 0.0
             and est.getMinWeightFractionPerNode() == 0.0 and not est.isSet("weightCol")
             and not est.isSet("thresholds") and est.getImpurity() in ("entropy", "gini"))
    if est.hasParam("numTrees"):
        usual &= est.getFeatureSubsetStrategy() == "all" and est.getSubsamplingRate() == 1.0
    return bool(usual)


def fit_model(est, data: DataFrame):
    """The fitted ``pyspark.ml`` model of a tree or forest estimator.

    Its class, parameters and class count come from a fit without splits on a few rows; the
    nodes are written beside them in the saved form and the whole is loaded.
    """
    spark = data.sparkSession
    label, features = est.getLabelCol(), est.getFeaturesCol()
    last = data.agg(F.max(label)).first()[0]
    few = data.where(F.col(label) == last).limit(1).unionByName(data.limit(est.getMaxBins())).coalesce(1)
    stub = est.copy({est.maxDepth: 0}).fit(few)
    forest = est.hasParam("numTrees")
    bare, path = scratch_path(spark, "tree-stub"), scratch_path(spark, "tree-model")
    stub.write().save(bare)
    nodes = fit_nodes(data, label, features, stub.numClasses, est.getNumTrees() if forest else 1,
                      forest and est.getBootstrap(), est.getMaxDepth(), est.getMaxBins(), est.getImpurity(),
                      est.getSeed())

    def deep(text: str) -> str:
        meta = json.loads(text)
        meta["paramMap"]["maxDepth"] = est.getMaxDepth()
        return json.dumps(meta)

    meta = spark.read.text(f"{bare}/metadata").first()["value"]
    spark.createDataFrame([(deep(meta),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    if forest:
        trees = [(r[0], deep(r[1]), r[2]) for r in spark.read.parquet(f"{bare}/treesMetadata").collect()]
        spark.createDataFrame(trees, "_1 int, _2 string, _3 double").coalesce(1) \
            .write.parquet(f"{path}/treesMetadata")
        nodes.write.parquet(f"{path}/data")
    else:
        nodes.select("nodeData.*").write.parquet(f"{path}/data")
    return type(stub).load(path)
