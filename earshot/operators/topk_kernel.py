"""The arithmetic inside one (users, shard of items) group."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

# Ship this module with the task, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NOTHING = np.iinfo(np.int64).min
USERS_AT_ONCE = 512
ITEMS_AT_ONCE = 2048
# A score takes about 70 bytes on its way to a key: 0.5 million of them 35 MB.
SCORES_AT_ONCE = 500_000
SLACK = 1.0 + 1e-6


def sort_keys(scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """One integer per (score, id), larger for better: score first, then lower id."""
    bits = (scores.astype(np.float32) + np.float32(0.0)).view(np.int32)
    ordered = np.where(bits < 0, bits ^ np.int32(0x7FFFFFFF), bits)
    return (ordered.astype(np.int64) << 32) + (0x7FFFFFFF - ids.astype(np.int64))


def read_keys(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The (scores, ids) that ``sort_keys`` packed."""
    ordered = (keys >> 32).astype(np.int32)
    bits = np.where(ordered < 0, ordered ^ np.int32(0x7FFFFFFF), ordered)
    ids = 0x7FFFFFFF - (keys & 0xFFFFFFFF)
    return bits.astype(np.int32).view(np.float32), ids.astype(np.int32)


def best_items(users: pa.Table, blocks: pa.Table, k: int, carry: bool) -> pa.Table:
    """The k best items of the shard for each user, only those above its floor.

    With ``carry`` also the user's vector and k-th best key, for another round.  A column
    ``rated`` holds ids that are not for the user.
    """
    n = users.num_rows
    floor = users["floor_key"].fill_null(NOTHING).to_numpy()
    keys = np.empty((n, k), dtype=np.int64)
    keys[:] = floor[:, None]
    if n and blocks.num_rows:
        # Both sides stay floats; only what is multiplied at a time is made doubles.
        vectors = _flat(users["features"]).reshape(n, -1)
        item_ids = _flat(blocks["ids"])
        items = _flat(blocks["flat"]).reshape(len(item_ids), -1)
        norms = _norms(items)
        by_norm = np.argsort(-norms, kind="stable")
        items, item_ids, norms = items[by_norm], item_ids[by_norm], norms[by_norm]
        barred = _barred(users, item_ids)
        at_once = max(1, min(USERS_AT_ONCE, SCORES_AT_ONCE // (k + ITEMS_AT_ONCE)))
        for start in range(0, n, at_once):
            part = slice(start, start + at_once)
            _improve(keys[part], vectors[part], items, item_ids, norms, barred.part(part))
    return _table(users, keys, floor, carry)


class Barred:
    """Pairs of a user's row and an item's place that are out, by row, then place."""

    def __init__(self, rows: np.ndarray, places: np.ndarray) -> None:
        order = np.lexsort((places, rows))
        self.rows, self.places = rows[order], places[order]

    def part(self, rows: slice) -> Barred:
        """Those of some rows, numbered from the first."""
        low, high = np.searchsorted(self.rows, (rows.start, rows.stop))
        return Barred(self.rows[low:high] - rows.start, self.places[low:high])

    def strike(self, keys: np.ndarray, rows: np.ndarray, start: int) -> None:
        """Take them out of ``keys``: of these rows, items from place ``start`` on."""
        at = np.searchsorted(rows, self.rows)
        at[at == len(rows)] = 0
        here = (self.places >= start) & (self.places < start + keys.shape[1])
        here &= rows[at] == self.rows
        keys[at[here], self.places[here] - start] = NOTHING


def _barred(users: pa.Table, item_ids: np.ndarray) -> Barred:
    if "rated" not in users.column_names:
        return Barred(np.empty(0, np.int64), np.empty(0, np.int64))
    lists = users["rated"].combine_chunks()
    counts = lists.value_lengths().fill_null(0).to_numpy()
    ids = lists.flatten().to_numpy()
    rows = np.repeat(np.arange(len(counts)), counts)
    by_id = np.argsort(item_ids, kind="stable")
    place = np.searchsorted(item_ids[by_id], ids)
    place[place == len(item_ids)] = 0
    there = item_ids[by_id[place]] == ids
    return Barred(rows[there], by_id[place[there]])


def _improve(
    keys: np.ndarray,
    vectors: np.ndarray,
    items: np.ndarray,
    item_ids: np.ndarray,
    norms: np.ndarray,
    barred: Barred,
) -> None:
    """Raise each row of ``keys`` to the best seen, skipping users who are done."""
    k = keys.shape[1]
    vectors = vectors.astype(np.float64)
    lengths = _norms(vectors) * SLACK
    for start in range(0, len(items), ITEMS_AT_ONCE):
        worst = keys.min(axis=1)
        open_ = worst == NOTHING
        kth, _ = read_keys(np.where(open_, 0, worst))
        # A zero vector scores 0 everywhere, so only ids matter to it: no skip.
        reach = lengths * norms[start]
        rows = np.flatnonzero(open_ | (reach >= kth))
        if not len(rows):
            return  # norms only fall from here
        block = items[start : start + ITEMS_AT_ONCE].astype(np.float64)
        scores = (vectors[rows] @ block.T).astype(np.float32)
        hit = open_[rows] | (scores.max(axis=1) >= kth[rows])
        rows, scores = rows[hit], scores[hit]
        if len(rows):
            found = sort_keys(scores, item_ids[None, start : start + ITEMS_AT_ONCE])
            barred.strike(found, rows, start)
            both = np.concatenate([keys[rows], found], axis=1)
            keys[rows] = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]


def _norms(vectors: np.ndarray) -> np.ndarray:
    """Lengths in double precision."""
    return np.sqrt(np.einsum("ij,ij->i", vectors, vectors, dtype=np.float64))


def _table(users: pa.Table, keys: np.ndarray, floor: np.ndarray, carry: bool) -> pa.Table:
    keys = np.sort(keys, axis=1)[:, ::-1]
    new = keys > floor[:, None]
    offsets = np.concatenate([[0], np.cumsum(new.sum(axis=1))]).astype(np.int32)
    scores, items = read_keys(keys[new])
    entries = pa.StructArray.from_arrays(
        [pa.array(items, pa.int32()), pa.array(scores, pa.float32())], names=["sourceId", "rating"]
    )
    found = {
        "id": users["id"],
        "recommendations": pa.ListArray.from_arrays(pa.array(offsets), entries),
    }
    if carry:
        kth = keys[:, -1]
        found["features"] = users["features"]
        found["kth_key"] = pa.array(kth, pa.int64(), mask=kth == NOTHING)
    return pa.table(found)


def _flat(column: pa.ChunkedArray) -> np.ndarray:
    """The values of a list column end to end."""
    chunks = [chunk.flatten() for chunk in column.chunks]
    return pa.chunked_array(chunks, column.type.value_type).to_numpy()
