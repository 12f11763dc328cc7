"""Folds of transition logs as stateful streams: the same steps as in batch, with one state per key in the state store."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """The state store that keyed state needs, for queries started within."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


class Fold(StatefulProcessor):
    """Takes a key's new entries in order (by the columns in order) through step; what a batch brings late is taken in its place within the batch only."""

    def __init__(self, step: Callable, state: str, order: tuple[str, ...]):
        self.step, self.schema, self.order = step, state, order

    def init(self, handle) -> None:  # noqa: ANN001
        self.state = handle.getValueState("state", self.schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: ANN001, N803
        names = [c.split()[0] for c in self.schema.split(", ")]
        held = dict(zip(names, self.state.get(), strict=True)) if self.state.exists() else None
        for row in sorted((r.asDict() for r in rows), key=lambda r: tuple(r[c] for c in self.order)):
            held, out = self.step(held, row)
            for o in out:
                yield Row(**o)
        if held is None:
            self.state.clear()
        else:
            self.state.update(tuple(held[n] for n in names))

    def close(self) -> None:
        pass


def folded(stream: DataFrame, key: str, order: tuple[str, ...], step: Callable, state: str, out: str) -> DataFrame:
    """Rows of out that step gives along each key's entries; the state outlives batches and restarts."""
    return stream.groupBy(key).transformWithState(Fold(step, state, order), out, "Append", "None")


def _put(document: dict, path: list[str], value: object) -> None:
    for name in path[:-1]:
        document = document[int(name)] if isinstance(document, list) else document.setdefault(name, {})
    if isinstance(document, list):
        document.extend([None] * (int(path[-1]) + 1 - len(document)))
        document[int(path[-1])] = value
    else:
        document[path[-1]] = value


def _take(document: dict, path: list[str]) -> None:
    for name in path[:-1]:
        document = document[int(name)] if isinstance(document, list) else document.get(name, {})
    if isinstance(document, dict):
        document.pop(path[-1], None)


def changed(image: str, updated: str | None, removed: list[str] | None) -> str | None:
    """The image after an update: fields by dotted names set and taken away; None if they don't fit the image."""
    document = json.loads(image)
    try:
        for name, value in json.loads(updated or "{}").items():
            _put(document, name.split("."), value)
        for name in removed if removed is not None else ():
            _take(document, name.split("."))
    except (ValueError, TypeError, IndexError, AttributeError):
        return None
    return json.dumps(document, ensure_ascii=False, separators=(",", ":"), sort_keys=True)


class CurrentImages(StatefulProcessor):
    """The current image of each document in keyed state: set by inserts, replacements and images of updates, changed by updates, gone after deletes."""

    def init(self, handle) -> None:  # noqa: ANN001
        self.image = handle.getValueState("image", "image string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N803
        frame = pd.concat(list(rows), ignore_index=True).sort_values(["file", "position"], kind="stable", ignore_index=True)
        now = self.image.get()[0] if self.image.exists() else None
        before, found = now, []
        for operation, image, updated, removed in zip(frame["operation_type"], frame["full_document"], frame["updated_fields"], frame["removed_fields"], strict=True):
            if operation == "delete":
                now = None
            elif isinstance(image, str):
                now = image
            elif operation == "update" and now is not None:
                now = changed(now, updated if isinstance(updated, str) else None, removed)
            found.append(now if operation == "update" else image if isinstance(image, str) else None)
        if now is None:
            self.image.clear()
        elif now != before:
            self.image.update((now,))
        frame["full_document"], frame["_key"] = found, key[0]
        yield frame

    def close(self) -> None:
        pass


def looked_up(events: DataFrame) -> DataFrame:
    """events (a stream of changefeed.watch()) whose updates carry the document as it is right after them; null if no image of it was seen.

    State holds one image for each document that is there. Rows of a document come in the order of file and position; rows
    without document key, as malformed text, are keys of their own.
    """
    own = F.when(F.col("document_key") != "", F.concat_ws("|", F.lit("k"), "namespace", "document_key")).otherwise(F.concat_ws("|", F.lit("r"), "file", F.col("position").cast("string")))
    keyed = events.withColumn("_key", own)
    out = T.StructType([T.StructField(f.name, f.dataType, True) for f in keyed.schema.fields])
    return keyed.groupBy("_key").transformWithStateInPandas(CurrentImages(), out, "Append", "None").drop("_key")
