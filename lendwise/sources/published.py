"""Versioned zones behind one pointer.

A run writes all its zones into a version folder of its own; readers follow
the pointer file ``CURRENT``, which is swapped by one rename when the run is
complete.  A run that dies while it writes changes nothing that readers see,
and a rerun starts a new version.

    <root>/versions/v000001/...      the zones of a run
    <root>/CURRENT                   name of the version that readers use
    <root>/DRAFT                     name of the version being written

Two runs at a time write different versions; the last to publish is read.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

_NAME = re.compile(r"v(\d{6,})-[0-9a-f]{8}$")


class Published:
    """The versions under one root, on any file system that Spark writes to."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._jvm = spark.sparkContext._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._hadoop.Path(f"{self.root}/{name}" if name else self.root)

    # -- pointers

    def _read(self, pointer: str) -> str | None:
        if not self._fs.exists(self._path(pointer)):
            return None
        stream = self._fs.open(self._path(pointer))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
        finally:
            stream.close()

    def _point(self, pointer: str, version: str) -> None:
        """Write beside the pointer, then replace it in one rename."""
        fresh = self._path(f".{pointer}-{uuid.uuid4().hex}")
        stream = self._fs.create(fresh, True)
        try:
            stream.write(bytearray(version.encode()))
        finally:
            stream.close()
        context = self._hadoop.FileContext.getFileContext(self._path("").toUri(), self._conf)
        rename = getattr(self._hadoop, "Options$Rename")
        how = self._gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        target = self._path(pointer).makeQualified(self._fs.getUri(), self._fs.getWorkingDirectory())
        context.rename(fresh.makeQualified(self._fs.getUri(), self._fs.getWorkingDirectory()), target, how)

    # -- versions

    def path(self, version: str) -> str:
        return f"{self.root}/versions/{version}"

    def versions(self) -> list[str]:
        """All version names, oldest first, complete or not."""
        folder = self._path("versions")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted((n for n in names if _NAME.match(n)), key=lambda n: (int(_NAME.match(n)[1]), n))

    def begin(self) -> str:
        """Start a new version; it becomes the draft."""
        last = self.versions()
        number = int(_NAME.match(last[-1])[1]) + 1 if last else 1
        version = f"v{number:06d}-{uuid.uuid4().hex[:8]}"
        self._fs.mkdirs(self._hadoop.Path(self.path(version)))
        self._point("DRAFT", version)
        return version

    def draft(self) -> str | None:
        """The version being written, None if there is none."""
        return self._read("DRAFT")

    def current(self) -> str | None:
        """The version that readers use, None before the first."""
        return self._read("CURRENT")

    def current_path(self) -> str:
        version = self.current()
        if version is None:
            raise FileNotFoundError(f"nothing is published under {self.root}")
        return self.path(version)

    def publish(self, version: str) -> str:
        """Make a complete version the one that readers use."""
        if not self._fs.exists(self._hadoop.Path(self.path(version))):
            raise FileNotFoundError(f"no version {version} under {self.root}")
        self._point("CURRENT", version)
        if self.draft() == version:
            self._fs.delete(self._path("DRAFT"), False)
        return self.path(version)

    def prune(self, keep: int = 2) -> list[str]:
        """Delete all but the newest ``keep`` versions up to the current one,
        unfinished ones among them; the current version and the draft stay.
        Returns the names that went."""
        current, draft = self.current(), self.draft()
        older = [v for v in self.versions() if v not in (current, draft)]
        if current is not None:
            older = [v for v in older if int(_NAME.match(v)[1]) <= int(_NAME.match(current)[1])]
        gone = older[:max(0, len(older) - (keep - 1))] if keep > 1 else older
        for version in gone:
            self._fs.delete(self._hadoop.Path(self.path(version)), True)
        return gone
