"""Recognition engines as Arrow-batched functions over images.

An engine is a function image bytes -> (text, confidence), made by a factory that is registered under a
name. It is made once in each task, not once a row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

Engine = Callable[[bytes], tuple[str, float]]
_FACTORIES: dict[str, Callable[[], Engine]] = {}


def register_engine(name: str, factory: Callable[[], Engine]) -> None:
    _FACTORIES[name] = factory


def engine_factory(name: str) -> Callable[[], Engine]:
    if name not in _FACTORIES:
        raise ValueError(f"no engine {name!r}; there are {sorted(_FACTORIES)}")
    return _FACTORIES[name]


def recognize(frames: DataFrame, primary: str, fallback: str | None = None, threshold: float = 0.7, image: str = "image") -> DataFrame:
    """frames without the image, with candidates array<struct<engine, text, confidence>>.

    The fallback runs only for rows whose primary confidence is below the threshold, in the same pass. A
    null image gives no candidates.
    """
    first = engine_factory(primary)
    second = engine_factory(fallback) if fallback is not None else None
    rest = [c for c in frames.columns if c != image]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frames.select(*rest).schema.fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        one, other = first(), None
        for batch in batches:
            found = []
            for content in batch[image]:
                if content is None:
                    found.append([])
                    continue
                text, confidence = one(bytes(content))
                candidates = [{"engine": primary, "text": text, "confidence": float(confidence)}]
                if second is not None and confidence < threshold:
                    other = other or second()
                    text, confidence = other(bytes(content))
                    candidates.append({"engine": fallback, "text": text, "confidence": float(confidence)})
                found.append(candidates)
            out = batch[rest].copy()
            out["candidates"] = found
            yield out

    return frames.select(*rest, image).mapInPandas(run, f"{fields}, candidates array<struct<engine: string, text: string, confidence: double>>")
