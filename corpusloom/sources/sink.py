"""Files in a shared folder, all of a run's or none: a Python data source whose tasks stage and whose commit moves.

Tasks write below a staging folder beside the target, each file under a name of its own attempt first, so an attempt that
fails leaves nothing that a later one doesn't replace. ``commit`` runs once, when all tasks have ended: a run that replaces
swaps the whole folder, two renames whatever the number of files; one that goes on moves its new numbered folders in, and
into the last old one file by file, which is one folder's files at most. ``abort`` removes what was staged.
"""

from __future__ import annotations

import contextlib
import os
import re
import shutil
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from corpusloom.functions.shipping import ship_for_texts

MODES = ("errorifexists", "overwrite", "append")


def local(path: str) -> str:
    """A shared folder's path as the operating system has it: executors write these files themselves, so other schemes are refused."""
    plain = re.sub(r"^file:(?://)?(?=/)", "", path)
    if re.match(r"^[A-Za-z][A-Za-z0-9+.-]*:", plain):
        raise ValueError(f"{path}: files are written to a folder that driver and executors share, not through a file system's scheme")
    return os.path.abspath(plain)


@dataclass
class Written(WriterCommitMessage):
    files: int


class FilesWriter(DataSourceWriter):
    """Rows of (folder, name, content), one file each; or of lines, one compressed file a task, of frames that can be read alone."""

    def __init__(self, options: dict[str, str]):
        self.path, self.mode, self.form, self.level = options["path"], options["mode"], options["form"], int(options.get("level", 15))
        self.frame_lines = int(options.get("frame_lines", 50_000))
        self.staging = options["staging"]

    def write(self, iterator: Iterator[Row]) -> Written:
        from pyspark import TaskContext

        context = TaskContext.get()
        mine = os.path.join(self.staging, "tmp", f"{context.partitionId()}-{context.taskAttemptId()}")
        os.mkdir(mine)  # fails where the run has been given up
        files = self._lines(iterator, mine, context.partitionId()) if self.form == "lines" else self._each(iterator, mine)
        shutil.rmtree(mine, ignore_errors=True)
        return Written(files)

    def _put(self, made: str, folder: str, name: str) -> None:
        target = os.path.join(self.staging, "files", folder)
        if not os.path.isdir(target):
            with contextlib.suppress(FileExistsError):
                os.mkdir(target)
        os.replace(made, os.path.join(target, name))

    def _each(self, rows: Iterator[Row], mine: str) -> int:
        n = 0
        for r in rows:
            made = os.path.join(mine, "next")
            with open(made, "w", encoding="utf-8", newline="") as f:
                f.write(r["content"])
            self._put(made, r["shard"], r["name"])
            n += 1
        return n

    def _lines(self, rows: Iterator[Row], mine: str, partition: int) -> int:
        import zstandard

        made = os.path.join(mine, "next")
        first = next(rows, None)
        if first is None:
            return 0
        with open(made, "wb") as raw, zstandard.ZstdCompressor(level=self.level).stream_writer(raw) as out:
            out.write(first["line"].encode() + b"\n")
            for n, r in enumerate(rows, 1):
                if n % self.frame_lines == 0:
                    out.flush(zstandard.FLUSH_FRAME)
                out.write(r["line"].encode() + b"\n")
        self._put(made, "", f"part-{partition:05d}.zst")
        return 1

    def commit(self, messages: list[Written | None]) -> None:
        new = os.path.join(self.staging, "files")
        try:
            if self.mode == "append" and os.path.isdir(self.path):
                self._move_in(new)
            else:
                if os.path.exists(self.path):
                    if self.mode == "errorifexists":
                        raise FileExistsError(f"{self.path} came into being while the run was under way")
                    os.rename(self.path, os.path.join(self.staging, "old"))
                os.rename(new, self.path)
        finally:
            self._clear()

    def _move_in(self, new: str) -> None:
        folders = sorted(os.listdir(new))
        old = [f for f in folders if os.path.isdir(os.path.join(self.path, f))]
        clash = [f"{f}/{n}" for f in old for n in os.listdir(os.path.join(new, f)) if os.path.exists(os.path.join(self.path, f, n))]
        if clash or any(os.path.isfile(os.path.join(self.path, f)) for f in folders):
            raise FileExistsError(f"there are such files already: {', '.join(clash[:5]) or folders}")
        for f in folders:
            if f in old:
                for n in os.listdir(os.path.join(new, f)):
                    os.rename(os.path.join(new, f, n), os.path.join(self.path, f, n))
            else:
                os.rename(os.path.join(new, f), os.path.join(self.path, f))

    def abort(self, messages: list[Written | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        """Tasks that are still at work can put a file back while the folder goes; they fail at their next one."""
        for _ in range(100):
            shutil.rmtree(self.staging, ignore_errors=True)
            if not os.path.exists(self.staging):
                return
            time.sleep(0.1)


class FilesSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "corpusloom_files"

    def writer(self, schema, overwrite: bool) -> FilesWriter:
        return FilesWriter({"path": self.options["target"], **self.options})


def put(rows: DataFrame, path: str, form: str, mode: str = "errorifexists", level: int = 15, frame_lines: int = 50_000) -> None:
    """Write rows of (shard, name, content), ``form`` files, or of (line), ``form`` lines, below ``path``.

    ``mode``: ``errorifexists`` refuses a folder that holds anything, ``overwrite`` replaces it, ``append`` adds to it.
    """
    if mode not in MODES:
        raise ValueError(f"mode is one of {', '.join(MODES)}")
    target = local(path)
    if mode == "errorifexists" and os.path.exists(target) and (not os.path.isdir(target) or os.listdir(target)):
        raise FileExistsError(f"{target} isn't empty: replace it (overwrite) or go on in it (append)")
    if mode == "errorifexists" and os.path.isdir(target):
        os.rmdir(target)
    staging = f"{target}.staging-{uuid.uuid4().hex[:12]}"
    for part in ("tmp", "files"):
        os.makedirs(os.path.join(staging, part))
    spark = rows.sparkSession
    ship_for_texts(spark)
    spark.dataSource.register(FilesSink)
    columns = ("line",) if form == "lines" else ("shard", "name", "content")
    rows.select(*columns).write.format("corpusloom_files").mode("append").options(target=target, staging=staging, mode=mode, form=form, level=str(level), frame_lines=str(frame_lines)).save()


def last_place(path: str) -> tuple[int, int]:
    """The highest numbered folder below ``path`` and how many files it holds; (0, 0) if there is none."""
    target = local(path)
    numbers = [int(f) for f in os.listdir(target) if re.fullmatch(r"[0-9]{5,}", f)] if os.path.isdir(target) else []
    return (max(numbers), len(os.listdir(os.path.join(target, f"{max(numbers):05d}")))) if numbers else (0, 0)
