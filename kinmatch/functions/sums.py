"""Sums of weights over posting lists in numpy: what one task does for some anchors and the lists that they meet."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: What best_sums() returns: an anchor, a candidate's number, its source, the sum and the place in the anchor's order.
RESULT = "s1_id string, s1_ord long, no long, source string, score double, rank int"
_TYPES = pa.schema([("s1_id", pa.string()), ("s1_ord", pa.int64()), ("no", pa.int64()), ("source", pa.string()), ("score", pa.float64()), ("rank", pa.int32())])


def rounded(x: np.ndarray) -> np.ndarray:
    """To six digits, halves away from zero as the engines round."""
    return np.copysign(np.floor(np.abs(x) * 1e6 + 0.5) / 1e6, x)


def _summed(ids: np.ndarray, weights: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct ids in order, their sums, their counts) of ids under n."""
    if 8 * len(ids) < n:
        own, at = np.unique(ids, return_inverse=True)
        return own, np.bincount(at, weights), np.bincount(at)
    counts = np.bincount(ids, minlength=n)
    own = np.flatnonzero(counts)
    return own, np.bincount(ids, weights, n)[own], counts[own]


def best_sums(probes: pa.Table, lists: pa.Table, k: int, floor: float | None, min_keys: int | None, per_source: bool) -> pa.Table:
    """The ``k`` best candidates of each anchor (and source): by sum, then by number, which follows the order of ordinals.

    probes: s1_id, s1_ord, country, name, key, factor, by_idf, over. lists: country, name, key, source, df, idf and nos, the
    numbers of the candidates, repeats included."""
    if not probes.num_rows or not lists.num_rows:
        return _TYPES.empty_table()
    at = lists.select(["country", "name", "key", "source", "df", "idf"]).to_pandas()
    at["list"] = np.arange(len(at))
    sources, source_of_list = np.unique(at["source"].to_numpy().astype(str), return_inverse=True)
    nos = lists.column("nos").combine_chunks()
    lens = pc.list_value_length(nos).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lens)
    numbers, ids = np.unique(nos.flatten().to_numpy(), return_inverse=True)
    source_of = np.zeros(len(numbers), np.int64)
    source_of[ids] = np.repeat(source_of_list, lens)

    met = probes.select(["s1_id", "s1_ord", "country", "name", "key", "factor", "by_idf", "over"]).to_pandas().merge(at.drop(columns="source"), on=["country", "name", "key"])
    met = met[~(met["df"] > met["over"])]
    met = met.sort_values(["s1_id", "s1_ord"], kind="stable", ignore_index=True)
    weight = (met["factor"] * np.where(met["by_idf"], met["idf"], 1.0)).to_numpy()
    used = met["list"].to_numpy()
    new = np.ones(len(met), bool)
    new[1:] = (met["s1_id"].to_numpy()[1:] != met["s1_id"].to_numpy()[:-1]) | (met["s1_ord"].to_numpy()[1:] != met["s1_ord"].to_numpy()[:-1])
    begins = np.flatnonzero(new)
    rows, found, scores, ranks = [], [], [], []
    for lo, hi in zip(begins, [*begins[1:], len(met)], strict=True):
        mine = used[lo:hi]
        own, score, count = _summed(np.concatenate([ids[ends[x] - lens[x] : ends[x]] for x in mine]), np.repeat(weight[lo:hi], lens[mine]), len(numbers))
        score = rounded(score)
        if min_keys is not None or floor is not None:
            keep = (count >= (min_keys or 0)) & (score >= (-np.inf if floor is None else floor))
            own, score = own[keep], score[keep]
        for s in range(len(sources)) if per_source else [None]:
            some = np.arange(len(own)) if s is None else np.flatnonzero(source_of[own] == s)
            if len(some) > k:  # all that may be among the best, in the order of numbers
                some = some[score[some] >= np.partition(score[some], len(some) - k)[len(some) - k]]
            some = some[np.argsort(-score[some], kind="stable")[:k]]
            rows.append(np.full(len(some), lo))
            found.append(own[some])
            scores.append(score[some])
            ranks.append(np.arange(1, len(some) + 1))
    if not rows:
        return _TYPES.empty_table()
    row, own = np.concatenate(rows), np.concatenate(found)
    first = met.iloc[row]
    columns = [pa.array(first["s1_id"], pa.string()), pa.array(first["s1_ord"], pa.int64()), pa.array(numbers[own], pa.int64()), pa.array(sources[source_of[own]].tolist(), pa.string())]
    return pa.Table.from_arrays([*columns, pa.array(np.concatenate(scores), pa.float64()), pa.array(np.concatenate(ranks), pa.int32())], schema=_TYPES)
