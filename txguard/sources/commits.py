"""Numbered commit files that exactly one writer can put in place."""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Callable
from random import random

from pyspark.sql import SparkSession

_DIGITS = 20
_END = "end"


class Commits:
    """A folder of commits 1, 2, 3, …; each is a line of text that is whole or not there.

    A commit is put in place only where its number is free. In a folder of the local file system (or
    one mounted there) a finished file gets its name by a link, which fails where the name exists. In
    others the file is created without overwriting, which HDFS decides atomically; a commit counts
    from when its last word is there. Object stores that overwrite silently are not supported.
    """

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._folder = self._path(path)
        self._fs = self._folder.getFileSystem(spark._jsc.hadoopConfiguration())
        self._folder = self._fs.makeQualified(self._folder)
        self._files = jvm.org.apache.commons.io.IOUtils
        self._charset = jvm.java.nio.charset.StandardCharsets.UTF_8
        local = self._fs.getScheme() == "file"
        self._local = self._folder.toUri().getPath() if local else None
        self._fs.mkdirs(self._folder)

    def last(self) -> int:
        """The highest number taken, 0 for none."""
        return max(self._numbers(), default=0)

    def _numbers(self) -> list[int]:
        names = (status.getPath().getName() for status in self._fs.listStatus(self._folder))
        return sorted(int(name) for name in names if name.isdigit())

    def read(self, after: int = 0) -> dict[int, str]:
        """Numbers and texts of the commits behind ``after``; those not finished are left out."""
        found = {}
        for number in self._numbers():
            if number > after:
                stream = self._fs.open(self._place(number))
                try:
                    text = self._files.toString(stream, self._charset)
                finally:
                    stream.close()
                if text.endswith(f"\n{_END}"):
                    found[number] = text[: -len(_END) - 1]
        return found

    def _place(self, number: int):
        return self._path(self._folder, f"{number:0{_DIGITS}d}")

    def put(self, number: int, text: str) -> bool:
        """Whether commit ``number`` could be put in place; false where there is one already."""
        whole = f"{text}\n{_END}".encode()
        if self._local is not None:
            draft = os.path.join(self._local, f".{uuid.uuid4().hex}")
            with open(draft, "xb") as file:
                file.write(whole)
            try:
                os.link(draft, os.path.join(self._local, f"{number:0{_DIGITS}d}"))
            except FileExistsError:
                return False
            finally:
                os.unlink(draft)
            return True
        if self._fs.exists(self._place(number)):
            return False
        try:
            stream = self._fs.create(self._place(number), False)
        except Exception as error:  # the other writer came first
            if "AlreadyExists" in str(error) or "AlreadyBeingCreated" in str(error):
                return False
            raise
        stream.write(bytearray(whole))
        stream.close()
        return True

    def append(self, make: Callable[[int], str], attempts: int = 1000) -> int:
        """Puts ``make(last)`` behind commit ``last``, again from the new last one whenever another writer was faster."""
        for attempt in range(attempts):
            last = self.last()
            if self.put(last + 1, make(last)):
                return last + 1
            time.sleep(random() * min(1.0, 0.01 * 2 ** min(attempt, 6)))
        raise TimeoutError(f"no free commit after {attempts} attempts")
