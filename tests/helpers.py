"""Small feeds for tests."""

from __future__ import annotations

import datetime as dt
import random

UTC = dt.timezone.utc
START = dt.datetime(2024, 3, 1, 12, 0, tzinfo=UTC)


def at(seconds: float) -> dt.datetime:
    return START + dt.timedelta(seconds=seconds)


def trades(spark, rows):
    """Rows of (symbol, seconds, seq, price, size, side)."""
    data = [(s, at(t), q, p, z, d) for s, t, q, p, z, d in rows]
    return spark.createDataFrame(data, "symbol string, ts timestamp, seq long, price double, size double, side string")


def random_trades(n=400, span=7200, hot=0.5, seed=1):
    """A feed where one symbol, and one instant of it, hold most of the rows."""
    rnd = random.Random(seed)
    rows = []
    for seq in range(n):
        symbol = "H" if rnd.random() < hot else rnd.choice("AB")
        when = 1234.5 if symbol == "H" and rnd.random() < 0.4 else round(rnd.uniform(0, span), 3)
        price = 0.0 if rnd.random() < 0.1 else round(rnd.uniform(90, 110), 2)
        rows.append((symbol, when, seq, price, float(rnd.randint(0, 9)), rnd.choice(["buy", "sell"])))
    return rows


def as_dicts(df, *order):
    rows = [r.asDict(recursive=True) for r in df.collect()]
    return sorted(rows, key=lambda r: tuple(r[c] for c in order))
