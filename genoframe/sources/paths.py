"""Turn the path a user gives into what Spark's file sources need."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass

from pyspark.sql import SparkSession

# Fixed value: the file names a directory scan picks up.
VCF_GLOB = "*.{vcf,vcf.gz}"


@dataclass(frozen=True)
class VcfPath:
    """A resolved input path.

    ``given`` is the user's spelling, which ``file_path`` values keep; ``root``
    is the same place as a full URI without percent encoding.
    """

    given: str
    root: str
    is_file: bool

    @property
    def load_path(self) -> str:
        """Path for Spark's readers, which would expand glob characters."""
        return re.sub(r"([\\\[\]{}*?])", r"\\\1", self.root)

    @property
    def stream_path(self) -> str:
        """Path for the file stream source, which takes a single file only by pattern."""
        if self.is_file and self.root[-1].isalnum():
            return f"{self.load_path[:-1]}[{self.root[-1]}]"
        return self.load_path

    @property
    def reader_options(self) -> dict[str, str]:
        """A file is taken whatever its name, a directory is searched recursively."""
        if self.is_file:
            return {}
        return {"recursiveFileLookup": "true", "pathGlobFilter": VCF_GLOB}


def resolve(spark: SparkSession, path: str) -> VcfPath | None:
    """Look the path up; None if it does not exist."""
    if not path:
        return None
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    located = hadoop.Path(path)
    fs = located.getFileSystem(conf)
    if fs.getScheme() == "file" and not located.toUri().getScheme():
        # The JVM keeps the working directory it was started in.
        located = hadoop.Path("file", None, os.path.abspath(path))
    if not fs.exists(located):
        return None
    qualified = fs.makeQualified(located)
    return VcfPath(
        given=path,
        root=qualified.toString(),
        is_file=fs.getFileStatus(qualified).isFile(),
    )
