"""Read only the head of a file, inside tasks.

The sample ids of a VCF file stand in its first lines. Finding them with a scan
means reading everything twice; opening each file and stopping at the ``#CHROM``
line costs a few kilobytes per file.

The functions that run in Python workers are nested, so that they travel with
the plan and the package need not be installed on the executors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql.functions import arrow_udf

from genoframe.functions.genotype import KEPT_SAMPLES_TYPE
from genoframe.functions.text import WHITESPACE
from genoframe.options import VcfOptions

HEADS_SCHEMA = "file_uri string, header_key string, sample_ids array<string>, problem string"
META_SCHEMA = "file_uri string, line string, problem string"
# Other names of storage schemes that the workers' library knows.
SCHEME_ALIASES = {"s3a": "s3", "s3n": "s3"}
# Suffixes of codecs that Spark decodes and the head reader does not.
OTHER_CODECS = (".deflate", ".snappy", ".lz4", ".zst", ".zstd")
# Names that leave a task at once, and files whose head a look-up remembers.
BATCH_BYTES = 16 << 20
REMEMBERED_FILES = 8


def head_reader(whole_file: bool = False) -> Callable[[str], tuple[list[str], list[str] | None]]:
    """Function from file URI to the ``##`` lines and sample ids of its head.

    The sample ids are None without a ``#CHROM`` line up to where the reading ends.
    It stops at the ``#CHROM`` line, or at the first other line: whether a header
    follows later is not for one task to find out. ``whole_file`` reads on, line by
    line. Files that cannot be opened or decoded raise.
    """
    whitespace, aliases, other_codecs = WHITESPACE, SCHEME_ALIASES, OTHER_CODECS

    def open_stored(uri: str):
        import io
        from urllib.parse import unquote, urlsplit

        scheme = urlsplit(uri).scheme
        if scheme in ("", "file"):
            return open(unquote(urlsplit(uri).path), "rb")
        from pyarrow import fs

        known = aliases.get(scheme, scheme) + uri[len(scheme) :]
        filesystem, path = fs.FileSystem.from_uri(known)
        return io.BufferedReader(filesystem.open_input_stream(path, compression=None))

    def decoded(raw, uri: str):
        import bz2
        import gzip

        if uri.endswith(".gz"):
            return gzip.GzipFile(fileobj=raw)
        if uri.endswith(".bz2"):
            return bz2.BZ2File(raw)
        if uri.endswith(other_codecs):
            raise ValueError(f"no reader for the codec of {uri}")
        return raw

    def read(uri: str) -> tuple[list[str], list[str] | None]:
        import io

        meta = []
        with open_stored(uri) as raw:
            # Bytes that are not UTF-8 read as they do in Spark.
            for line in io.TextIOWrapper(decoded(raw, uri), encoding="utf-8", errors="replace"):
                if line.startswith("##"):
                    meta.append(line.strip(whitespace))
                elif line.startswith("#CHROM"):
                    return meta, line.strip(whitespace).split("\t")[9:]
                elif line.strip(whitespace) and not line.startswith("#") and not whole_file:
                    break
        return meta, None

    return read


def can_open(uri: str) -> str | None:
    """Why workers cannot open files of this scheme; None if they can."""
    from urllib.parse import urlsplit

    scheme = urlsplit(uri).scheme
    if scheme in ("", "file"):
        return None
    from pyarrow import ArrowException, fs

    try:
        fs.FileSystem.from_uri(SCHEME_ALIASES.get(scheme, scheme) + uri[len(scheme) :])
    except (OSError, ValueError, ImportError, ArrowException) as error:
        return str(error)
    return None


def sample_chooser(options: VcfOptions) -> Callable[[list[str]], list[dict]]:
    """Function from sample ids to the selected ones with their position."""
    include, exclude = frozenset(options.include_samples), frozenset(options.exclude_samples)

    def choose(sample_ids: list[str]) -> list[dict]:
        return [
            {"idx": i, "sampleId": name}
            for i, name in enumerate(sample_ids)
            if (not include or name in include) and name not in exclude
        ]

    return choose


def read_heads(meta: bool = False):
    """Task over file URIs, for ``mapInArrow``: one row per file.

    A header that several files share leaves a task once, under its key. A file
    whose head does not settle it has a ``problem`` instead. With ``meta`` there is
    a row per distinct ``##`` line. Rows leave in batches of bounded size.
    """
    read, limit = head_reader(), BATCH_BYTES

    def attempt(uri: str) -> tuple[list[str], list[str] | None, str | None]:
        import zlib

        from pyarrow import ArrowException

        try:
            lines, sample_ids = read(uri)
        except (OSError, ValueError, ImportError, EOFError, zlib.error, ArrowException) as error:
            return [], None, f"{type(error).__name__}: {error}"
        return lines, sample_ids, None if sample_ids is not None else "no #CHROM line in its head"

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        import pyarrow

        kinds = {
            "file_uri": pyarrow.string(),
            "header_key": pyarrow.string(),
            "sample_ids": pyarrow.list_(pyarrow.string()),
            "problem": pyarrow.string(),
        }
        if meta:
            kinds = {name: pyarrow.string() for name in ("file_uri", "line", "problem")}

        def packed(rows: list[dict]) -> pa.RecordBatch:
            columns = {n: pyarrow.array([r[n] for r in rows], t) for n, t in kinds.items()}
            return pyarrow.RecordBatch.from_pydict(columns)

        sent, rows, held = set(), [], 0
        for batch in batches:
            for uri in batch["file_uri"].to_pylist():
                lines, sample_ids, problem = attempt(uri)
                if meta:
                    # A head without #CHROM may still hold metadata; the scan finds all of it.
                    found = [] if problem else list(dict.fromkeys(lines))
                    more = [{"file_uri": uri, "line": x, "problem": None} for x in found]
                    more += [{"file_uri": uri, "line": None, "problem": problem}] if problem else []
                    held += sum(len(x) + len(uri) for x in found)
                else:
                    key = None
                    if sample_ids is not None:
                        names = f"{len(sample_ids)}:" + "\t".join(sample_ids)
                        key = hashlib.sha256(names.encode("utf-8", "replace")).hexdigest()
                    new = key not in sent
                    sent.add(key)
                    more = [
                        {
                            "file_uri": uri,
                            "header_key": key,
                            "sample_ids": sample_ids if new else None,
                            "problem": problem,
                        }
                    ]
                    held += sum(map(len, sample_ids or ())) + 8 * len(sample_ids or ()) if new else 200
                rows += more
                if held > limit:
                    yield packed(rows)
                    rows, held = [], 0
        yield packed(rows)

    return heads


def _remembering(read: Callable[[str], object], most: int) -> Callable[[str], object]:
    """The reader with the answers of the last few files."""
    known: dict[str, object] = {}

    def head_of(uri: str) -> object:
        if uri not in known:
            if len(known) >= most:
                known.pop(next(iter(known)))
            known[uri] = read(uri)
        return known[uri]

    return head_of


def has_header_udf():
    """UDF from file URI to whether the file has a ``#CHROM`` line.

    A file that cannot be opened fails the task: dropping its rows would be silent.
    """
    read = head_reader(whole_file=True)
    has_header = _remembering(lambda uri: read(uri)[1] is not None, REMEMBERED_FILES)

    @arrow_udf("boolean")
    def file_has_header(uris: pa.Array) -> pa.Array:
        import pyarrow

        files = uris.dictionary_encode()
        found = [has_header(uri) for uri in files.dictionary.to_pylist()]
        return pyarrow.array(found, pyarrow.bool_()).take(files.indices)

    return file_has_header


def kept_samples_udf(options: VcfOptions):
    """UDF from file URI to its selected samples, empty without a ``#CHROM`` line.

    A batch of rows goes out in slices of bounded size, since a wide cohort repeated
    for each row would outgrow what one Arrow array of text can hold.
    """
    read, choose, limit = head_reader(whole_file=True), sample_chooser(options), BATCH_BYTES
    kept_of = _remembering(lambda uri: choose(read(uri)[1] or []), REMEMBERED_FILES)

    @arrow_udf(KEPT_SAMPLES_TYPE)
    def kept_samples_of_file(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import pyarrow

        sample = pyarrow.struct([("idx", pyarrow.int32()), ("sampleId", pyarrow.string())])
        for uris in batches:
            names = uris.to_pylist()
            if not names:
                yield pyarrow.array([], pyarrow.list_(sample))
            start = 0
            while start < len(names):
                kept = kept_of(names[start])
                size = 16 + sum(len(s["sampleId"].encode()) + 16 for s in kept)
                end, most = start + 1, start + max(1, limit // size)
                while end < min(most, len(names)) and names[end] == names[start]:
                    end += 1
                one = pyarrow.array([kept], pyarrow.list_(sample))
                yield one.take(pyarrow.array([0] * (end - start), pyarrow.int64()))
                start = end

    return kept_samples_of_file
