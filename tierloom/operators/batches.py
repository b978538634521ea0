"""Arrow batches in pieces of bounded size, whatever number of rows a session puts into a batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from tierloom.session import carry_to_workers

carry_to_workers(__name__)


def cuts(sizes: np.ndarray, most_rows: int, most: int) -> Iterator[tuple[int, int]]:
    """Bounds of runs of rows, in order: at most ``most_rows`` of them with sizes of at most ``most`` together, or a single row."""
    total = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    begin = 0
    while begin < len(sizes):
        end = int(np.searchsorted(total, total[begin] + most, "right")) - 1
        end = min(max(end, begin + 1), begin + most_rows, len(sizes))
        yield begin, end
        begin = end
