"""Python tasks hand their rows on in batches and hold what they read as plain columns."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from tapeworks.operators import book
from tapeworks.streaming import book as SK
from tapeworks.streaming import state as SS
from tapeworks.streaming import ticks as ST
from tapeworks.streaming.packed import gather


class Value:
    def __init__(self):
        self.row = None

    def exists(self):
        return self.row is not None

    def get(self):
        return self.row

    def update(self, row):
        self.row = row

    def clear(self):
        self.row = None


class Rows(Value):
    def get(self):
        return iter(self.row or [])

    def appendList(self, rows):
        assert len(rows) <= SS.PIECE_ROWS
        self.row = (self.row or []) + rows


class Handle:
    def __init__(self):
        self.states, self.timers = {}, []

    def getValueState(self, name, schema):
        return self.states.setdefault(name, Value())

    def getListState(self, name, schema):
        return self.states.setdefault(name, Rows())

    def registerTimer(self, ms):
        self.timers.append(ms)


class Mark:
    def __init__(self, us):
        self.ms = us // 1000

    def getCurrentWatermarkInMs(self):
        return self.ms


def changes(n, levels=60):
    return pd.DataFrame({
        "us": np.arange(n) * 1_000_000, "seq": np.arange(n), "part": np.zeros(n, "int32"), "kind": np.zeros(n, "int8"),
        "side": (np.arange(n) % 2).astype("int8"), "price": 100.0 + np.arange(n) // 2 % levels, "size": 1.0 + np.arange(n) % 3,
    })


def frames(pdf, size=500):
    return (pdf.iloc[i:i + size] for i in range(0, len(pdf), size))


def test_a_fold_hands_books_on_before_it_has_read_a_chunk():
    """The whole chunk's books used to be one frame of Python objects."""
    read, n = [], 12_000

    def batches():
        for pdf in frames(changes(n)):
            read.append(len(pdf))
            side = pdf["side"].map({0: "sell", 1: "buy"})
            yield pa.RecordBatch.from_pandas(pd.DataFrame({
                "symbol": "X", "_chunk": 0, "_sub": 0, "_change": True, "_us": pdf["us"], "seq": pdf["seq"],
                "kind": "l2update", "side": side, "price": pdf["price"], "size": pdf["size"],
            }), preserve_index=False)

    made, seen = [], []
    for batch in book.fold_books(batches(), 1_000_000, 1 << 30):
        made.append(batch)
        seen.append(sum(read))
    assert seen[0] < n / 2 and sum(len(b) for b in made) == n
    assert max(len(b.column(4).flatten()) + len(b.column(5).flatten()) for b in made) <= book.BATCH_LEVELS + 120
    last = pa.Table.from_batches(made).to_pylist()[-1]
    assert (last["bucket"], len(last["bids"]), len(last["asks"])) == ((n - 1) * 1_000_000, 60, 60)
    assert [x["price"] for x in last["bids"]] == [159.0 - i for i in range(60)]


def test_a_fold_starts_each_chunk_with_its_levels():
    rows = [("X", 0, 0, True, 5, 1, "l2update", "buy", 9.0, 1.0), ("X", 10, 0, False, None, None, None, "buy", 8.0, 4.0),
            ("X", 10, 0, False, None, None, None, "sell", 12.0, 2.0), ("X", 10, 0, True, 11, 2, "l2update", "buy", 9.0, 3.0)]
    names = ["symbol", "_chunk", "_sub", "_change", "_us", "seq", "kind", "side", "price", "size"]
    made = pa.Table.from_batches(book.fold_books([pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows])], 10, 5)).to_pylist()
    assert [(r["_chunk"], r["bucket"], [x["price"] for x in r["bids"]], [x["price"] for x in r["asks"]]) for r in made] == [
        (0, 0, [9.0], []), (10, 10, [9.0, 8.0], [12.0])]


def keeper(step=1_000_000, k=50, keep=50):
    made = SK.BookKeeper(step, k, keep)
    made.init(Handle())
    return made


def test_a_streaming_book_hands_its_books_on_in_batches():
    """One key's books of a micro-batch used to come out as one frame."""
    feed = changes(4000).sample(frac=1, random_state=3)
    made = list(keeper().handleInputRows(("X",), frames(feed), None))
    assert len(made) > 5 and sum(map(len, made)) == 3999
    levels = [sum(map(len, pdf["bids"])) + sum(map(len, pdf["asks"])) for pdf in made]
    assert max(levels) <= SK.BATCH_LEVELS + 100
    assert pd.concat(made)["bucket"].is_monotonic_increasing


def test_a_message_of_both_kinds_has_its_first_kind_first():
    held = {"us": np.array([7, 5, 5, 5, 6]), "seq": np.array([3, 1, 1, 1, 2]), "part": np.array([0, 0, 1, 2, 0]),
            "kind": np.array([0, 0, 1, 0, 1], "int8")}
    assert SK.message_order(held).tolist() == [1, 3, 2, 4, 0]


def test_running_trades_hand_rows_on_piece_by_piece():
    n = 50_000
    feed = pd.DataFrame({"us": np.arange(n), "seq": np.arange(n), "price": 1.0 + np.arange(n) % 7, "size": 1.0, "side": "buy"})
    feed.loc[25_000:25_010, ["price", "size"]] = None

    class State:
        exists, row = False, None

        def update(self, row):
            self.row = row

    state = State()
    made = list(SS._follow(("X",), frames(feed.sample(frac=1, random_state=5)), state, False))
    assert max(map(len, made)) <= SS.PIECE_ROWS and len(made) == 3
    rows = pd.concat(made, ignore_index=True)
    assert rows["cvd"].tolist() == feed["size"].fillna(0).cumsum().tolist()
    assert rows["previous_price"].tolist()[1:] == feed["price"].ffill().tolist()[:-1]
    assert state.row == (float(n - 11), feed["price"].iloc[-1], n - 1, 0)


def test_ordered_trades_release_and_keep_piece_by_piece():
    n, cut = 90_000, 45_000
    feed = pd.DataFrame({"us": np.arange(n) * 1000, "seq": np.arange(n), "price": 1.0, "size": 1.0, "side": "sell"})
    handle = Handle()
    made = SS.TradesInOrder(False, None)
    made.init(handle)
    first = list(made.handleInputRows(("X",), frames(feed.sample(frac=1, random_state=5)), Mark(cut * 1000)))
    assert max(map(len, first)) <= SS.PIECE_ROWS and sum(map(len, first)) == cut
    assert len(handle.states["waiting"].row) == n - cut and handle.timers == [cut + 1]
    rest = list(made.handleExpiredTimer(("X",), Mark(n * 1000), None))
    rows = pd.concat(first + rest, ignore_index=True)
    assert rows["seq"].tolist() == list(range(n)) and rows["cvd"].iloc[-1] == -n
    assert max(map(len, rest)) <= SS.PIECE_ROWS and not list(handle.states["waiting"].get())


def test_quiet_ticks_come_out_in_batches():
    step, n = 1_000_000, 3000
    none = np.array([])
    rows = pd.DataFrame([{
        "bucket": b, "buy_volume": 1.0, "sell_volume": 0.0, "trade_count": 1, "vwap": 1.0, "avg_price": 1.0, "signed": 1.0, "ofi": 0.0,
        **{f"change_{c}": none for c in ST.CHANGES}, "first_price": 1.0, "first_signed": 1.0, "last_trade": 1.0, "last_price": 1.0,
        "ticker": [1.0, 1.0, 1.0, 1.0, 1.0], "quote": [1.0, 2.0],
    } for b in (n * step, 0)])
    maker = ST.TickMaker(step, {"1s": step, "1h": 3600 * step}, 50)
    maker.init(Handle())
    made = list(maker.handleInputRows(("X",), [rows], None))
    assert max(map(len, made)) <= ST.BATCH_TICKS and sum(map(len, made)) == n + 1
    whole = pd.concat(made, ignore_index=True)
    assert whole["seq"].tolist() == [i * step for i in range(n + 1)] and whole["volume_1h"].iloc[-2:].tolist() == [1.0, 2.0]


def tick_steps(n, seed=3):
    """Steps of one symbol with silences, tickers without a price, and book changes, in no order."""
    rnd, step, bucket, rows = np.random.default_rng(seed), 1_000_000, 0, []
    for i in range(n):
        bucket += step * int(rnd.choice([1, 1, 1, 2, 9, 400]))
        m, traded = int(rnd.integers(0, 4)), bool(rnd.random() < 0.6)
        price = [float(x) for x in rnd.integers(90, 110, 3)]
        rows.append({
            "bucket": bucket, "buy_volume": float(rnd.integers(0, 5)) if traded else 0.0, "sell_volume": float(rnd.integers(0, 5)) if traded else 0.0,
            "trade_count": int(traded), "vwap": price[0], "avg_price": price[0] if traded else None, "signed": 1.0 if traded else None,
            "ofi": float(m), "change__us": bucket + np.arange(m), "change_seq": np.arange(m), "change_kind_code": np.zeros(m, "int8"),
            "change_side_code": (np.arange(m) % 2).astype("int8"), "change_price": rnd.integers(95, 105, m).astype(float),
            "change_size": rnd.integers(0, 3, m).astype(float), "first_price": price[0] if traded else None,
            "first_signed": 1.0 if traded else None, "last_trade": price[1] if traded else None, "last_price": price[2] if traded else None,
            "ticker": None if i % 5 else [0.0 if i % 20 == 10 else 100.0 + i, 1.0, 2.0, None, 4.0], "quote": None if i % 7 else [99.0, 101.0],
        })
    return step, pd.DataFrame(rows)


def made_ticks(step, widths, parts):
    maker = ST.TickMaker(step, widths, 50)
    maker.init(Handle())
    return pd.concat([x for part in parts for x in maker.handleInputRows(("X",), iter(part), None)], ignore_index=True)


def test_ticks_do_not_depend_on_micro_batches_and_look_back_like_a_scan(monkeypatch):
    step, rows = tick_steps(120)
    widths = {"1s": 1, "1min": 7, "1h": 60, "24h_calculated": 1000, "odd": 2.5}
    widths = {n: int(w * step) for n, w in widths.items()}
    whole = made_ticks(step, widths, [[rows.sample(frac=1.0, random_state=1)]])
    monkeypatch.setattr(ST, "BATCH_TICKS", 300)
    cut = made_ticks(step, widths, [frames(rows[:50].sample(frac=1.0, random_state=2), 7), frames(rows[50:51]), frames(rows[51:])])
    pd.testing.assert_frame_equal(whole, cut)
    assert len(whole) > 2000 and (whole["seq"].diff().dropna() > step).any()  # no ticks while the ticker has no price
    at, price, buy, sell = (whole[c].to_numpy() for c in ("seq", "price", "buy_vol", "sell_vol"))
    for name, width in widths.items():
        for i in range(0, len(whole), 13):
            span = (at > at[i] - width) & (at <= at[i])
            p, b, s = price[span], buy[span].sum(), sell[span].sum()
            move = price[i] - p[0]
            want = [p.max(), p.min(), move, move / p[0] * 100, b + s, b, s]
            assert whole.loc[i, [f"{m}_{name}" for m in ST.METRICS]].tolist() == pytest.approx(want, abs=1e-9), (name, i)


def test_a_long_silence_is_laid_out_in_batches_of_numbers():
    step, rows = tick_steps(2)
    rows["bucket"] = [0, 3 * ST.BATCH_TICKS * step]
    maker = ST.TickMaker(step, {"1s": step, "24h_calculated": 86_400 * step}, 50)
    maker.init(Handle())
    made = list(maker.handleInputRows(("X",), [rows], None))
    assert max(map(len, made)) <= ST.BATCH_TICKS and sum(map(len, made)) == 3 * ST.BATCH_TICKS + 1
    assert {k.kind for x in made for c, k in x.dtypes.items() if c not in ("symbol", "ts")} <= set("if")  # no book in a tick


def test_gathered_columns_own_their_values():
    pdf = changes(1000)
    held = gather(frames(pdf, 300), ["us", "price", "side"])
    assert {c: v.dtype.name for c, v in held.items()} == {"us": "int64", "price": "float64", "side": "int8"}
    assert all((held[c] == pdf[c].to_numpy()).all() for c in held)
    assert [len(v) for v in gather([], ["us"]).values()] == [0]
