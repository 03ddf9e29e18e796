"""Custom stateful stream operators (STR3 cross-window, STR13, STR14).

``applyInPandasWithState`` keeps one small state per key (waiting events, or
recent timestamps and hour counts); state is dropped by an event-time timeout,
so it stays bounded by the watermark.  One task handles a key's rows of one
micro-batch, with vectorised NumPy: bound them by the source's rows per trigger.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from tessera.functions.geo import EARTH_RADIUS_KM

US = 1_000_000


GEO_OUT = ("customer_id LONG, transaction_id LONG, prev_transaction_id LONG, "
           "seconds_apart DOUBLE, distance_km DOUBLE")
# the last complete event, then the events that the watermark has not passed
GEO_STATE = "us ARRAY<LONG>, id ARRAY<LONG>, lat ARRAY<DOUBLE>, lng ARRAY<DOUBLE>, has_last BOOLEAN"


def _hav_km_np(lat1, lng1, lat2, lng2):
    p1, p2 = np.radians(lat1), np.radians(lat2)
    a = np.sin((p2 - p1) / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin(np.radians(lng2 - lng1) / 2) ** 2
    return 2 * EARTH_RADIUS_KM * np.arctan2(np.sqrt(a), np.sqrt(1 - a))


def geo_jumps_stateful(txns: DataFrame, time_col="event_time", customer="customer_id",
                       id_col="transaction_id", lat="lat", lng="lng", max_seconds=300,
                       min_km=50.0, watermark="5 minutes") -> DataFrame:
    """STR3 (stateful): consecutive events of a customer, also across window
    edges and micro-batches, <= ``max_seconds`` apart and > ``min_km`` apart.

    Events wait in the state until the watermark has passed them; only then is
    their order final, and each is paired with the one before it.  Rows that
    come late but inside the watermark therefore take their place in time.
    Events at or after the final watermark of a finished stream are not paired.
    The state of a customer holds the events of one watermark delay."""
    df = (txns.withWatermark(time_col, watermark)
              .select(F.col(customer).cast("long").alias("customer_id"),
                      F.col(id_col).cast("long").alias("transaction_id"),
                      F.unix_micros(F.col(time_col)).alias("us"), F.col(time_col).alias("event_time"),
                      F.col(lat).cast("double").alias("lat"), F.col(lng).cast("double").alias("lng")))

    def fn(key, pdfs, state):
        us, tid, la, ln, has_last = state.get if state.exists else ([], [], [], [], False)
        new = [] if state.hasTimedOut else list(pdfs)
        parts = [pd.DataFrame({"us": us, "transaction_id": tid, "lat": la, "lng": ln}).astype(
            {"us": "int64", "transaction_id": "int64", "lat": float, "lng": float})]
        x = pd.concat(parts + [p[["us", "transaction_id", "lat", "lng"]] for p in new], ignore_index=True)
        # the last complete event stays first: nothing before it can still come
        x = pd.concat([x.iloc[:1], x.iloc[1:].sort_values(["us", "transaction_id"])]) if has_last \
            else x.sort_values(["us", "transaction_id"])
        us, tid = x["us"].to_numpy(np.int64), x["transaction_id"].to_numpy(np.int64)
        la, ln = x["lat"].to_numpy(float), x["lng"].to_numpy(float)
        wm_us = state.getCurrentWatermarkMs() * 1000
        done = max(int(np.searchsorted(us, wm_us, side="left")), 1 if has_last else 0)
        if done >= 2:
            dt = (us[1:done] - us[:done - 1]) / US
            d = _hav_km_np(la[:done - 1], ln[:done - 1], la[1:done], ln[1:done])
            hit = (dt >= 0) & (dt <= max_seconds) & (d > min_km)
            if hit.any():
                yield pd.DataFrame({"customer_id": key[0], "transaction_id": tid[1:done][hit],
                                    "prev_transaction_id": tid[:done - 1][hit], "seconds_apart": dt[hit],
                                    "distance_km": d[hit]})
        keep = max(done - 1, 0)
        if done == len(us) and us[-1] + max_seconds * US < wm_us:
            state.remove()      # no later event can pair with the last one
            return
        state.update((us[keep:].tolist(), tid[keep:].tolist(), la[keep:].tolist(), ln[keep:].tolist(), bool(done)))
        # wake up when the watermark passes the first waiting event, or when the last complete one is too old
        nxt = us[done] // 1000 + 1 if done < len(us) else (us[-1] + max_seconds * US) // 1000 + 1
        state.setTimeoutTimestamp(max(int(nxt), state.getCurrentWatermarkMs() + 1))

    return df.groupBy("customer_id").applyInPandasWithState(
        fn, GEO_OUT, GEO_STATE, "append", GroupStateTimeout.EventTimeTimeout)


SPIKE_OUT = ("merchant_id LONG, transaction_id LONG, rolling_count LONG, hour_count LONG, "
             "prev_hours_count LONG, baseline DOUBLE, is_spike BOOLEAN")
SPIKE_STATE = "recent ARRAY<LONG>, hours ARRAY<LONG>, counts ARRAY<LONG>, max_us LONG"


def spikes_stateful(txns: DataFrame, time_col="event_time", merchant="merchant_id",
                    id_col="transaction_id", window_seconds=300, factor=3.0,
                    watermark="1 hour", watermark_seconds=3600, horizon_hours=1) -> DataFrame:
    """STR14: per merchant, rolling count and an hourly baseline ((running count
    of the hour + counts of the ``horizon_hours`` hours before) / (horizon + 1)).

    Events count as they arrive: micro-batches in their order, by time inside
    one.  A row that comes late but inside the watermark is counted in its own
    hour and window, among the rows seen so far; the batch operator gives the
    same numbers where rows arrive in order of time.  The state keeps a count
    for each open hour, and the times of one window plus the watermark delay
    (``watermark_seconds`` is the delay that ``watermark`` names)."""
    df = (txns.withWatermark(time_col, watermark)
              .select(F.col(merchant).cast("long").alias("merchant_id"),
                      F.col(id_col).cast("long").alias("transaction_id"),
                      F.unix_micros(F.col(time_col)).alias("us"), F.col(time_col).alias("event_time")))
    win_us, hour_us, delay_us = window_seconds * US, 3600 * US, watermark_seconds * US

    def fn(key, pdfs, state):
        if state.hasTimedOut:
            state.remove()
            return
        recent, hours, counts, max_us = state.get if state.exists else ([], [], [], 0)
        recent = np.asarray(recent, dtype=np.int64)
        seen = dict(zip(hours, counts))
        pdf = pd.concat(list(pdfs), ignore_index=True).sort_values(["us", "transaction_id"])
        us = pdf["us"].to_numpy(np.int64)
        tid = pdf["transaction_id"].to_numpy(np.int64)
        pos = np.arange(len(us))
        # rows of the window: earlier ones of this micro-batch, and those of the state (kept sorted)
        rolling = (pos - np.searchsorted(us, us - win_us, side="left") + 1
                   + np.searchsorted(recent, us, side="right") - np.searchsorted(recent, us - win_us, side="left"))
        bucket = us - us % hour_us
        ub, first, inv, n_here = np.unique(bucket, return_index=True, return_inverse=True, return_counts=True)
        before = np.array([seen.get(int(b), 0) for b in ub], dtype=np.int64)
        hour_count = pos - first[inv] + 1 + before[inv]
        here = dict(zip(ub.tolist(), n_here.tolist()))
        prior = np.array([sum(here.get(int(b) - h * hour_us, 0) + seen.get(int(b) - h * hour_us, 0)
                              for h in range(1, horizon_hours + 1)) for b in ub], dtype=np.int64)
        prev = prior[inv]
        base = (hour_count + prev) / (horizon_hours + 1.0)
        spike = (base > 0) & (rolling > factor * base)
        max_us = max(max_us, int(us[-1]))
        for b, n in here.items():
            seen[b] = seen.get(b, 0) + n
        oldest = max_us - delay_us  # no row before this one still comes
        seen = {b: n for b, n in seen.items() if b >= oldest - oldest % hour_us - horizon_hours * hour_us}
        times = np.sort(np.concatenate([recent, us]))
        state.update((times[times >= oldest - win_us].tolist(), list(seen), list(seen.values()), max_us))
        state.setTimeoutTimestamp(max((max_us + (horizon_hours + 1) * hour_us) // 1000, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"merchant_id": key[0], "transaction_id": tid, "rolling_count": rolling,
                            "hour_count": hour_count, "prev_hours_count": prev, "baseline": base,
                            "is_spike": spike})

    return df.groupBy("merchant_id").applyInPandasWithState(
        fn, SPIKE_OUT, SPIKE_STATE, "append", GroupStateTimeout.EventTimeTimeout)
