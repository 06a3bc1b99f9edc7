"""Loss monitoring on a stream of log rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from corpusmill.operators.ordered import fold_runs
from corpusmill.operators.sampling import every_n

OUTPUT = "run string, step bigint, loss double, ema double"


def monitor_loss(stream: DataFrame, every: int = 10) -> DataFrame:
    """``step, loss`` of every n-th step, as they arrive."""
    return every_n(stream, "step", every).select("step", "loss")


# Rows of a run that are smoothed and given back at a time.
BLOCK = 65_536
NO_STEP = np.iinfo(np.int64).min


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    """One array of all ``parts``, which are let go."""
    whole = np.concatenate(parts)
    parts.clear()
    return whole


_STATE = "last double, step bigint, seen bigint, steps binary, losses binary"


def smoothed_loss(stream: DataFrame, alpha: float = 0.98, every: int = 1, lateness: int = 0) -> DataFrame:
    """Smoothed loss per run in step order: ``run, step, loss, ema``.

    ``stream`` has ``run, step, loss``. The rows of a run that come in one micro-batch are taken together, in order of (step, loss), however Spark cuts
    them into chunks. With ``lateness``, a row waits in the state until one that is so many steps further has come, so rows may arrive out of order by
    that much; rows still waiting when the stream stops are smoothed when it goes on. A row that comes later still has a NULL average.
    The state of a run is its last average and the rows that wait. The task of a run holds a step, a loss and a place for each row of a micro-batch, in
    arrays; rows are smoothed and given back in blocks. For a log that is complete use the batch operator ``ema``.
    """

    def fold(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, at, seen, waiting, held = state.get if state.exists else (None, None, None, b"", b"")
        steps, losses = [np.frombuffer(waiting, dtype=np.int64)], [np.frombuffer(held, dtype=np.float64)]
        absent = []  # rows without a step wait
        for p in pdfs:
            none = p["step"].isna().to_numpy()
            absent.append(np.array(p["loss"][none], dtype=np.float64))
            # Copies, so that the chunk they come from is let go.
            steps.append(np.array(p["step"][~none], dtype=np.int64))
            losses.append(np.array(p["loss"][~none], dtype=np.float64))
        steps, losses = _joined(steps), _joined(losses)
        order = np.lexsort((losses, steps))
        if len(order):
            seen = max(NO_STEP if seen is None else int(seen), int(steps[order[-1]]))
        wait_losses, begun = [_joined(absent)], at
        wait_steps = [np.full(len(wait_losses[0]), NO_STEP)]
        for i in range(0, len(order), BLOCK):
            rows = order[i : i + BLOCK]
            step, loss = steps[rows], losses[rows]
            late = step < begun if begun is not None else np.zeros(len(rows), dtype=bool)
            ready = ~late & (step <= seen - lateness)
            ema = np.full(len(rows), np.nan)
            if ready.any():
                values = np.concatenate([[] if last is None else [last], loss[ready]])
                one_run = np.zeros(len(values), dtype=int)
                smooth = fold_runs(values, one_run, one_run, alpha)
                ema[ready] = smooth[len(values) - int(ready.sum()) :]
                last, at = float(smooth[-1]), int(step[ready][-1])
            wait_steps.append(step[~late & ~ready])
            wait_losses.append(loss[~late & ~ready])
            shown = late | ready
            yield pd.DataFrame({"run": key[0], "step": step[shown], "loss": loss[shown], "ema": ema[shown]})
        state.update((last, at, seen, _joined(wait_steps).tobytes(), _joined(wait_losses).tobytes()))

    smoothed = stream.groupBy("run").applyInPandasWithState(fold, OUTPUT, _STATE, "append", GroupStateTimeout.NoTimeout)
    return every_n(smoothed, "step", every)
