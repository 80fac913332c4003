"""Versioned table store with an atomic publish.

Every load claims a number N of its own, writes its tables under ``<root>/v<N>/``
and then publishes a small JSON manifest ``<root>/_manifests/v<N>.json``. Readers
pick the highest published manifest, so a load that fails before publishing
leaves the previous version readable, and a version's data is never
overwritten. All file access goes through the Hadoop FileSystem of the path.

Loads may overlap. One that builds on version M commits by creating
``_manifests/after-<M>.json``, which only one can: the file comes to its name whole and
never replaces another. The loser gets ``LostRaceError`` and has to build anew on what
won. Should the winner die before its manifest stands under its own name, whoever finds
the commit completes it. The store must be one that can refuse to replace a file.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

MANIFEST_DIR = "_manifests"
CLAIM_DIR = "_claims"
_VERSION = re.compile(r"^v(\d+)\.json$")
_DIR = re.compile(r"^v(\d+)$")


class LostRaceError(RuntimeError):
    """Another load published a version since the one this load was built on."""


@dataclass
class Manifest:
    version: int
    body: dict


class VersionedStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._Path = self._jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._Path(self.root).getFileSystem(self._conf)

    # --- paths -----------------------------------------------------------
    def version_dir(self, version: int) -> str:
        return f"{self.root}/v{version}"

    def table_path(self, version: int, table: str) -> str:
        return f"{self.version_dir(version)}/{table}"

    def _manifest_path(self, version: int) -> str:
        return f"{self.root}/{MANIFEST_DIR}/v{version}.json"

    # --- manifests -------------------------------------------------------
    def versions(self) -> list[int]:
        mdir = self._Path(f"{self.root}/{MANIFEST_DIR}")
        if not self._fs.exists(mdir):
            return []
        out = []
        for status in self._fs.listStatus(mdir):
            m = _VERSION.match(status.getPath().getName())
            if m:
                out.append(int(m.group(1)))
        return sorted(out)

    def current(self) -> Manifest | None:
        vs = self.versions()
        if not vs:
            return None
        return self.manifest(vs[-1])

    def manifest(self, version: int) -> Manifest:
        return Manifest(version, self._read_text(self._manifest_path(version)))

    # --- retention -------------------------------------------------------
    def list_dirs(self, relative: str) -> list[str]:
        """Names of the directories below ``<root>/<relative>``."""
        path = self._Path(f"{self.root}/{relative}")
        if not self._fs.exists(path):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(path) if s.isDirectory()]

    def glob(self, relative: str) -> list[str]:
        """Paths below the root that match a pattern."""
        found = self._fs.globStatus(self._Path(f"{self.root}/{relative}"))
        return [f.getPath().toString() for f in found] if found else []

    def version_dirs(self) -> list[int]:
        return sorted(int(m.group(1)) for d in self.list_dirs("") if (m := _DIR.match(d)))

    def delete(self, relative: str) -> int:
        """Delete ``<root>/<relative>``; 1 if it was there."""
        return int(self._fs.delete(self._Path(f"{self.root}/{relative}"), True))

    def delete_manifest(self, version: int) -> None:
        self._fs.delete(self._Path(self._manifest_path(version)), False)

    def next_version(self) -> int:
        """One past every published manifest, every version directory and every claim, so
        a load that died before publishing never collides with its retry."""
        used = [*self.versions(), *self.version_dirs(), *self._claims()]
        return max(used) + 1 if used else 1

    def _claims(self) -> list[int]:
        path = self._Path(f"{self.root}/{CLAIM_DIR}")
        return [int(s.getPath().getName()) for s in self._fs.listStatus(path)] if self._fs.exists(path) else []

    def claim(self) -> int:
        """A version number that no other load has. Read the version to build on first: then
        numbers rise in the order of publishing."""
        while True:
            version = self.next_version()
            if self._create(f"{CLAIM_DIR}/{version}", ""):
                return version

    def _create(self, relative: str, text: str) -> bool:
        """Make a whole file come to its name; False if there is one already."""
        final, tmp = (self._Path(f"{self.root}/{r}") for r in (relative, f"{MANIFEST_DIR}/{uuid.uuid4().hex}.tmp"))
        self._write_text(tmp, text)
        try:
            if self._fs.getScheme() == "file":
                nio = self._jvm.java.nio.file
                link, target = (nio.Path.of(self._fs.makeQualified(x).toUri().getPath(), self._strings([])) for x in (final, tmp))
                self._fs.mkdirs(final.getParent())
                nio.Files.createLink(link, target)  # fails where the name exists; a rename would replace it
            else:
                self._fs.mkdirs(final.getParent())
                context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
                rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
                options = self.spark.sparkContext._gateway.new_array(rename, 1)
                options[0] = rename.NONE
                context.rename(tmp, final, options)
        except Py4JJavaError as e:
            if "AlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        finally:
            self._fs.delete(tmp, False)
        return True

    def _strings(self, values: list[str]):
        out = self.spark.sparkContext._gateway.new_array(self._jvm.java.lang.String, len(values))
        for i, v in enumerate(values):
            out[i] = v
        return out

    def _write_text(self, path, text: str) -> None:
        out = self._fs.create(path, True)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()

    def publish(self, version: int, body: dict, base: int | None = None) -> Manifest:
        """Make ``version`` the current one. With ``base`` (0: the store was empty) only if that is still current."""
        text = json.dumps({**body, "version": version}, sort_keys=True, default=str)
        if base is not None:
            commit = f"{MANIFEST_DIR}/after-{base}.json"
            if max(self.versions(), default=0) != base or not self._create(commit, text):
                self._complete(f"{self.root}/{commit}")
                raise LostRaceError(f"version {base} of {self.root} was followed by another while this load was built on it")
        if not self._create(f"{MANIFEST_DIR}/v{version}.json", text) and base is None:
            raise FileExistsError(f"version {version} already published in {self.root}")
        return Manifest(version, body)

    def _complete(self, commit: str) -> None:
        """Give a committed manifest its own name if its load didn't come to that."""
        if self._fs.exists(self._Path(commit)):
            body = self._read_text(commit)
            self._create(f"{MANIFEST_DIR}/v{body['version']}.json", json.dumps(body, sort_keys=True))

    def _read_text(self, path: str) -> dict:
        stream = self._fs.open(self._Path(path))
        try:
            reader = self.spark.sparkContext._jvm.java.io.BufferedReader(
                self.spark.sparkContext._jvm.java.io.InputStreamReader(stream, "UTF-8")
            )
            lines = []
            line = reader.readLine()
            while line is not None:
                lines.append(line)
                line = reader.readLine()
        finally:
            stream.close()
        return json.loads("\n".join(lines))
