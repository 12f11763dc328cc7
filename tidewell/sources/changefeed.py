"""A streaming source of raw change documents: landed files of one JSON document a line, in the order of their names.

register(spark) makes it known; spark.readStream.format("changefeed") takes the options
  path              the folder as a URI that pyarrow opens (watch() makes one of any path). Files may lie in folders within it,
                    as day/hour/file: folders that end before the place are not listed again
  checkpoint        the query's checkpoint folder as a URI. A restart learns from it where it goes on, so that maxFilesPerBatch
                    holds from the first batch on; without it the first batch after a restart takes all there is
  startAt           earliest, latest (default), or an RFC 3339 time (used without a checkpoint only); watch() also leaves out
                    changes from before that time, as a file may hold both
  startAfter        JSON of a place (start_place()): goes before startAt
  maxFilesPerBatch  how many files one batch reads at most (default: all there are)
  bytesPerTask      files are cut in ranges of so many bytes on line borders (default 64 MB)
  failOnDataLoss    true (default): HistoryLost if files that were not read yet are gone, LateFile if one landed behind the
                    place; false: go on with what there is
The offset is the last file read, the file after it if one was there, and the newest landing time so far. It lives in the
query's checkpoint, which takes the place of resume tokens. Consumed files may be removed by trim(), which notes the last name.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import pyarrow.fs as pf
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidewell.operators import normalize

LINES, BLOCK = 4_096, 1 << 20
#: Holds the name of the last file that trim() took away.
REMOVED = "_removed"


class HistoryLost(RuntimeError):
    """ChangeStreamHistoryLost: the resume point is no longer in the log."""


class LateFile(RuntimeError):
    """A file landed under a name behind the place, so its changes would never be read."""


class Landed(NamedTuple):
    name: str
    landed: int  # nanoseconds
    size: int


class FileRange(InputPartition):
    def __init__(self, name: str, start: int, end: int):
        super().__init__(name)
        self.name, self.start, self.end = name, start, end


def _open(path: str) -> tuple[pf.FileSystem, str]:
    if "://" not in path:
        raise ValueError(f"{path} has no scheme: executors must all find the same folder, so name it as a URI")
    files, root = pf.FileSystem.from_uri(path)
    return files, root.rstrip("/")


def qualified(spark: SparkSession, path: str) -> str:
    """path as a URI, with the scheme of Spark's own file system if it has none."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()
    return uri if "://" in uri else uri.replace(":", "://", 1)


def listed(path: str, after: str = "") -> list[Landed]:
    """The files below path in the order of their names (relative to it), without those in folders that end before after."""
    files, root = _open(path)

    def below(folder: str) -> Iterator[Landed]:
        for i in files.get_file_info(pf.FileSelector(f"{root}/{folder}".rstrip("/"), allow_not_found=True)):
            name = f"{folder}/{i.base_name}".lstrip("/")
            if i.base_name.startswith((".", "_")):
                continue
            if i.is_file:
                yield Landed(name, i.mtime_ns or 0, i.size)
            elif name >= after[: len(name)]:
                yield from below(name)

    return sorted(below(""))


def _removed(path: str) -> str:
    files, root = _open(path)
    if files.get_file_info(f"{root}/{REMOVED}").type == pf.FileType.NotFound:
        return ""
    with files.open_input_stream(f"{root}/{REMOVED}") as f:
        return f.read().decode()


def trim(path: str, last: str) -> int:
    """Take away the files up to the name last, after noting it; gives their number."""
    files, root = _open(path)
    with files.open_output_stream(f"{root}/.{REMOVED}") as f:
        f.write(max(last, _removed(path)).encode())
    files.move(f"{root}/.{REMOVED}", f"{root}/{REMOVED}")
    gone = [x.name for x in listed(path) if x.name <= last]
    for name in gone:
        files.delete_file(f"{root}/{name}")
    return len(gone)


def start_place(path: str, start: str) -> dict:
    """Where a feed starts that has read nothing: behind the last file (latest), before all (earliest), or before what landed since a time."""
    found = listed(path)
    if start == "latest":
        behind = found
    elif start == "earliest":
        behind = []
    else:
        since = dt.datetime.fromisoformat(start)
        ns = int((since if since.tzinfo else since.replace(tzinfo=dt.UTC)).timestamp() * 1e9)
        last = max((x.name for x in found if x.landed < ns), default="")
        behind = [x for x in found if x.name <= last]
    after = max((x.name for x in behind), default="")
    return {"after": after, "next": next((x.name for x in found if x.name > after), ""), "landed": max((x.landed for x in behind), default=0)}


def last_place(checkpoint: str) -> dict | None:
    """The offset of the last batch that a checkpoint has planned; None if there is none."""
    files, root = _open(checkpoint)
    found = [i for i in files.get_file_info(pf.FileSelector(f"{root}/offsets", allow_not_found=True)) if i.base_name.isdigit()]
    if not found:
        return None
    with files.open_input_stream(max(found, key=lambda i: int(i.base_name)).path) as f:
        return json.loads(f.read().decode().splitlines()[-1])


def pending(path: str, checkpoint: str) -> int:
    """How many files are behind what a checkpoint has planned."""
    place = last_place(checkpoint) or {"after": ""}
    return sum(x.name > place["after"] for x in listed(path, place["after"]))


class Reader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.start, self.given = options["path"], options.get("startat", "latest"), options.get("startafter")
        self.most, self.strict = int(options.get("maxfilesperbatch", 0)), options.get("failondataloss", "true").lower() == "true"
        self.range = int(options.get("bytespertask", 64 << 20))
        # Spark may ask for the latest offset ahead of the first one.
        self.place = (last_place(options["checkpoint"]) or self._first()) if options.get("checkpoint") else None

    def _first(self) -> dict:
        return json.loads(self.given) if self.given else start_place(self.path, self.start)

    def initialOffset(self) -> dict:
        first = self._first()
        self.place = self.place or first
        return first  # also where a first batch that failed begins again

    def _behind(self, place: dict) -> list[Landed]:
        """What is to be read from place on; a failure if some of it is gone or came too late."""
        after, found = place["after"], listed(self.path, place["after"])
        names = {x.name for x in found}
        if self.strict:
            if place["next"] and place["next"] not in names:
                raise HistoryLost(f"ChangeStreamHistoryLost: {place['next']} was not read yet and is gone")
            if (mark := _removed(self.path)) > after and (after or place["landed"]):
                raise HistoryLost(f"ChangeStreamHistoryLost: files up to {mark} are gone, read up to {after}")
            if late := [x.name for x in found if x.name <= after and x.landed > place["landed"]]:
                raise LateFile(f"{', '.join(late[:5])} landed behind {after}")
        return [x for x in found if x.name > after]

    def latestOffset(self) -> dict:
        place = self.place or {"after": "", "next": "", "landed": 0}
        new = self._behind(place)
        if not new:
            return place
        taken = new[: self.most] if self.most and self.place else new
        return {"after": taken[-1].name, "next": new[len(taken)].name if len(new) > len(taken) else "", "landed": max(place["landed"], *(x.landed for x in taken))}

    def partitions(self, start: dict, end: dict) -> list[FileRange]:
        self.place = end
        taken = [x for x in self._behind(start) if x.name <= end["after"]]
        return [FileRange(x.name, at, min(at + self.range, x.size)) for x in taken for at in range(0, x.size, self.range)]

    def read(self, partition: FileRange) -> Iterator[pa.RecordBatch]:
        """The lines that begin in the range, each with the byte it begins at."""
        files, root = _open(self.path)
        with files.open_input_file(f"{root}/{partition.name}") as f:
            at, rest, lines, places = max(partition.start - 1, 0), b"", [], []
            f.seek(at)
            skipping = partition.start > 0  # up to the end of the line that began before
            while (block := f.read(BLOCK)) or rest:
                *whole, rest = (rest + block).split(b"\n") if block else (rest, b"")
                for line in whole:
                    if not skipping and at >= partition.end:
                        rest = b""
                        break
                    if not skipping and line:
                        lines.append(line)
                        places.append(at)
                    skipping, at = False, at + len(line) + 1
                else:
                    if len(lines) >= LINES:
                        yield from self._batches(partition.name, places, lines)
                        lines, places = [], []
                    if block:
                        continue
                break
            yield from self._batches(partition.name, places, lines)

    @staticmethod
    def _batches(name: str, places: list[int], lines: list[bytes]) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(lines), LINES):
            text = [x.decode("utf-8", "replace") for x in lines[i : i + LINES]]
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(text)), pa.array(places[i : i + LINES], pa.int64()), pa.array(text)], names=["file", "position", "raw"])

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


class ChangeFeed(DataSource):
    @classmethod
    def name(cls) -> str:
        return "changefeed"

    def schema(self) -> str:
        return "file string, position bigint, raw string"

    def streamReader(self, schema) -> Reader:  # noqa: ANN001
        return Reader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ChangeFeed)


def watch(spark: SparkSession, path: str, database: str = "", collection: str = "", malformed: bool = False, **options: str) -> DataFrame:
    """Change events of one collection, of a database's collections, or (neither named) of all, as a stream, with file and position.

    malformed: texts that are no document come along too, in the column malformed, which is null for events.
    """
    if collection and not database:
        raise ValueError("a collection is watched within a database")
    register(spark)
    for name in {"checkpoint"} & options.keys():
        options[name] = qualified(spark, options[name])
    raws = spark.readStream.format("changefeed").option("path", qualified(spark, path)).options(**options).load()
    events = normalize.normalize(raws, database, collection, keep=("file", "position"), malformed=malformed)
    own = F.col("malformed").isNotNull() if malformed else F.lit(False)
    if options.get("startAt", "latest") not in ("latest", "earliest"):
        since = dt.datetime.fromisoformat(options["startAt"])
        since = since.astimezone(dt.UTC).replace(tzinfo=None) if since.tzinfo else since
        events = events.where(own | (F.col("timestamp") >= F.lit(since).cast("timestamp_ntz")) | (F.col("timestamp") == F.expr("timestamp_ntz '1970-01-01 00:00:00'")))
    events = events.where(own | (F.col("database") == database)) if database else events
    return events.where(own | (F.col("collection") == collection)) if collection else events


def level(database: str = "", collection: str = "") -> str:
    """What a feed watches."""
    return "collection" if collection else "database" if database else "cluster"
