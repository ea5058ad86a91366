"""Fill-in-middle: texts cut into prefix, middle and suffix, and put in another order.

A unit is a word with the white space before it, or white space at the end of a text.
One match of ``(unit)*`` over the whole text keeps every repetition of the group, so
the ends of its captures are the ends of all units: their number and both cuts come
from that one list.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from genoframe.llm.batches import returning_memory, small_batches

# Marks of the parts, white space, and the prefix of what is hashed.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SPACE = r"\x20\x09-\x0D"
SALT = "42:"
# Per cent of the texts that are changed, and of those that put the suffix first.
CHANGED, SUFFIX_FIRST = 50, 80

UNITS = regex.compile(rf"([{SPACE}]*+[^{SPACE}]++|[{SPACE}]++)*+")
# Where white space follows a word, a unit ends whatever stands before it.
BOUNDARY = regex.compile(rf"[^{SPACE}](?=[{SPACE}])")
MARKS = regex.compile("|".join((PREFIX, SUFFIX, MIDDLE)))
# Characters for one match: the library keeps some 60 bytes per capture and gives up
# at a gigabyte.
STRETCH = 1 << 20


@dataclass(frozen=True)
class Parts:
    """A text in its parts. ``form`` is plain, psm or spm; a plain text is all prefix."""

    n: int
    form: str
    prefix: str
    middle: str = ""
    suffix: str = ""

    def output(self) -> str:
        if self.form == "plain":
            return self.prefix
        if self.form == "psm":
            return f"{PREFIX}{self.prefix}{SUFFIX}{self.suffix}{MIDDLE}{self.middle}"
        return f"{SUFFIX}{self.suffix}{PREFIX}{self.prefix}{MIDDLE}{self.middle}"


def unit_ends(text: str, stretch: int = STRETCH) -> list[int]:
    """Offsets behind each unit.

    A text of more than ``stretch`` characters is matched in stretches that end
    where a unit does, so its units are the same.
    """
    if len(text) <= stretch:
        return UNITS.fullmatch(text).ends(1)
    ends: list[int] = []
    start = 0
    while start < len(text):
        cut = BOUNDARY.search(text, start + stretch)
        end = cut.end() if cut else len(text)
        ends += UNITS.fullmatch(text, start, end).ends(1)
        start = end
    return ends


def draws(doc_id: object, salt: str = SALT) -> tuple[int, int, int, int]:
    """Four unsigned 32-bit numbers of a document; a null id counts as an empty one."""
    name = f"{salt}{'' if doc_id is None else doc_id}"
    digest = hashlib.sha256(name.encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))


def cut(
    doc_id: object,
    text: str,
    salt: str = SALT,
    changed: int = CHANGED,
    suffix_first: int = SUFFIX_FIRST,
) -> Parts:
    """Cut a text as the hash of its id says."""
    ends = unit_ends(text)
    h1, h2, h3, h4 = draws(doc_id, salt)
    if not text or h3 % 100 >= changed or MARKS.search(text):
        return Parts(len(ends), "plain", text)
    first, second = sorted((h1 % (len(ends) + 1), h2 % (len(ends) + 1)))
    low, high = (ends[k - 1] if k else 0 for k in (first, second))
    form = "spm" if h4 % 100 < suffix_first else "psm"
    return Parts(len(ends), form, text[:low], text[low:high], text[high:])


def restore(output: str, form: str) -> str:
    """The text that an output was made of. Changed texts hold no mark themselves."""
    if form == "plain":
        return output
    first, middle = output.split(MIDDLE)
    if form == "psm":
        prefix, suffix = first[len(PREFIX) :].split(SUFFIX)
    else:
        suffix, prefix = first[len(SUFFIX) :].split(PREFIX)
    return prefix + middle + suffix


def fill_in_middle(
    docs: DataFrame,
    salt: str = SALT,
    changed: int = CHANGED,
    suffix_first: int = SUFFIX_FIRST,
    digests: bool = False,
) -> DataFrame:
    """The rows of ``docs`` as doc_id, n, form, output, prefix_chars, middle_chars.

    ``n`` is the number of units, lengths are in code points and null for plain texts.
    Null text counts as empty, a null id as an empty one; both are plain or cut like
    any other. Rows with one id are cut alike if their texts are equal. Texts of any
    length are cut whole. With ``digests``, output_sha256 and restored_sha256, of the
    text rebuilt from output and form, stand in place of output. No documents give no
    rows.
    """
    small_batches(docs.sparkSession)
    texts = ("output_sha256", "restored_sha256") if digests else ("output",)

    def digest(text: str) -> str:
        return hashlib.sha256(text.encode()).hexdigest()

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                parts = cut(doc_id, text.as_py() or "", salt, changed, suffix_first)
                output = parts.output()
                if digests:
                    made = (digest(output), digest(restore(output, parts.form)))
                else:
                    made = (output,)
                is_cut = parts.form != "plain"
                lengths = (len(parts.prefix), len(parts.middle)) if is_cut else (None, None)
                rows.append((parts.n, parts.form, *lengths, *made))
            n, form, prefix, middle, *made = zip(*rows) if rows else [()] * (4 + len(texts))
            columns = {
                "doc_id": batch["doc_id"],
                "n": pa.array(n, pa.int64()),
                "form": pa.array(form, pa.string()),
                "prefix_chars": pa.array(prefix, pa.int64()),
                "middle_chars": pa.array(middle, pa.int64()),
            }
            columns |= {name: pa.array(m, pa.string()) for name, m in zip(texts, made)}
            yield pa.RecordBatch.from_pydict(columns)

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {doc_id}, n bigint, form string, prefix_chars bigint, middle_chars bigint"
    schema += "".join(f", {name} string" for name in texts)
    return docs.select("doc_id", "text").mapInArrow(returning_memory(transform), schema)
