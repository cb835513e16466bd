"""The rows a key got in a micro-batch: held as plain columns, taken in order piece by piece."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd

# Rows of a key that are worked on, and handed on, at a time.
PIECE_ROWS = 20_000


def gather(frames: Iterable[pd.DataFrame], columns: list[str]) -> dict[str, np.ndarray]:
    """The columns of all frames, as arrays that grow in place: nothing else of a frame stays in memory."""
    held: dict[str, np.ndarray] = {c: np.empty(0) for c in columns}
    n = 0
    for frame in frames:
        for c in columns:
            values = frame[c].to_numpy()
            have = held[c] if n else np.empty(0, values.dtype)
            have = have.astype(np.result_type(have, values), copy=False)
            if n + len(values) > len(have):
                have.resize(max(n + len(values), len(have) * 5 // 4), refcheck=False)
            have[n:n + len(values)] = values
            held[c] = have
        n += len(frame)
    return {c: values[:n] for c, values in held.items()}


def pieces(held: dict[str, np.ndarray], order: np.ndarray, rows: int = PIECE_ROWS) -> Iterator[dict[str, np.ndarray]]:
    """The rows at ``order``, so many at a time."""
    for start in range(0, len(order), rows):
        yield {c: values[order[start:start + rows]] for c, values in held.items()}
