"""M6: one bad series fails alone. Kernels run on chunks of series; a chunk that raises is run series by series."""

from __future__ import annotations

FAILED = "failed"
#: What a kernel yields: forecasts, and for a series that raised one row of phase ``failed`` with the error.
KERNEL_SCHEMA = "item_id long, phase string, t long, yhat double, error string"


def isolated(kernel, part):
    """Frames of ``kernel(part)`` (a generator); if it raises, those of each of its series, or the series' error."""
    import pandas as pd
    try:
        frames = list(kernel(part))
    except MemoryError:
        raise
    except Exception as e:  # whatever a solver raises on one series must not stop the others
        if len(part) > 1:
            for k in range(len(part)):
                yield from isolated(kernel, part.iloc[k:k + 1])
            return
        frames = [pd.DataFrame({"item_id": part["item_id"].to_numpy(), "phase": FAILED, "t": None, "yhat": float("nan"),
                                "error": f"{type(e).__name__}: {e}"[:500]}).astype({"t": "Int64"})]
    for frame in frames:
        yield frame if "error" in frame else frame.assign(error=None)
