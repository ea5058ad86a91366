"""URL rules by a bit-parallel wildcard automaton.

All glob rules stand side by side in one long bit mask, cut into 64-bit words. A
state bit says that a rule has matched up to this symbol; reading a character is
a shift, an and with the character's mask, and an or with the places of ``*``.
numpy takes that step for every URL of a batch at once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
# URLs that step together; longer batches are cut.
LANES = 4096


@dataclass(frozen=True)
class UrlRule:
    """A host with all its subdomains, and the start of the path."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    UrlRule("org", "/", ALLOW),
    UrlRule("example.org", "/es/", BLOCK),
    UrlRule("example.org", "/en/1", BLOCK),
    UrlRule("com", "/fr/", ALLOW),
    UrlRule("com", "/de/", BLOCK),
)
# Words that block a host where no rule fits. They bind whole words of a
# label, so spills and antispam stay. A default to start from; pass a list of your own.
BLOCKED_WORDS = (
    "casino", "casinos", "cheap", "cialis", "escort", "escorts", "jackpot", "levitra",
    "malware", "phishing", "pills", "poker", "porn", "porno", "roulette", "spam",
    "spammer", "spammers", "viagra", "xanax", "xxx",
)
BLOCKED_HOSTS = tuple(f"*.{word}.*" for word in BLOCKED_WORDS)
# What separates the words of a host becomes a dot before globs of blocked hosts see it.
SEPARATORS = str.maketrans("-_:", "...")


class GlobAutomaton:
    """Globs over bytes; ``*`` stands for any bytes, also none. No other wildcard."""

    def __init__(self, globs: list[str]):
        self.globs = globs
        symbols, loops, firsts, lasts = [], [], [], []
        for glob in globs:
            literal = re.sub(r"\*+", "*", glob).encode()
            # One bit for each literal and one before them that stands for the start.
            firsts.append(len(symbols))
            symbols.append(None)
            loops.append(False)
            for byte in literal:
                if byte == ord("*"):
                    loops[-1] = True
                else:
                    symbols.append(byte)
                    loops.append(False)
            lasts.append(len(symbols) - 1)
        self.words = max(1, -(-len(symbols) // 64))
        self.lasts = np.array(lasts, dtype=np.int64)
        self.start = self._mask(firsts)
        self.stay = self._mask([i for i, loop in enumerate(loops) if loop])
        by_byte: dict[int, list[int]] = {}
        for i, symbol in enumerate(symbols):
            by_byte.setdefault(-1 if symbol is None else symbol, []).append(i)
        self.masks = np.stack([self._mask(by_byte.get(byte, [])) for byte in range(256)])

    def _mask(self, bits: list[int]) -> np.ndarray:
        mask = np.zeros(self.words, dtype=np.uint64)
        for bit in bits:
            mask[bit // 64] |= np.uint64(1 << (bit % 64))
        return mask

    def matches(self, texts: list[bytes]) -> np.ndarray:
        """Boolean matrix: text by glob."""
        found = np.zeros((len(texts), len(self.globs)), dtype=bool)
        for low in range(0, len(texts), LANES):
            found[low : low + LANES] = self._lanes(texts[low : low + LANES])
        return found

    def _lanes(self, texts: list[bytes]) -> np.ndarray:
        lengths = np.array([len(text) for text in texts], dtype=np.int64)
        # Longest first: the texts that still have a character are the first ones.
        order = np.argsort(-lengths, kind="stable")
        lengths = lengths[order]
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        begins = np.concatenate([[0], np.cumsum([len(text) for text in texts])])[:-1][order]
        state = np.tile(self.start, (len(texts), 1))
        one, top = np.uint64(1), np.uint64(63)
        for place in range(int(lengths[0]) if len(lengths) else 0):
            active = int(np.searchsorted(-lengths, -place, side="left"))
            here = state[:active]
            moved = here << one
            moved[:, 1:] |= here[:, :-1] >> top
            masks = self.masks[data[begins[:active] + place]]
            state[:active] = (moved & masks) | (here & self.stay)
        bits = state[:, self.lasts // 64] >> (self.lasts % 64).astype(np.uint64) & one
        found = np.empty((len(texts), len(self.globs)), dtype=bool)
        found[order] = bits.astype(bool)
        return found


def _judge(rules: tuple[UrlRule, ...], blocked_hosts: tuple[str, ...]):
    # Longest rule first, so the first that fits wins; equal lengths keep their order.
    ranked = sorted(rules, key=lambda rule: -len(rule.name))
    # Hosts and paths are matched apart, so no host wildcard runs on into a path.
    hosts_of_rules = [f"{sub}{rule.host}" for rule in ranked for sub in ("", "*.")]
    by_host = GlobAutomaton(hosts_of_rules)
    by_words = GlobAutomaton(list(blocked_hosts))
    by_path = GlobAutomaton([f"{rule.path}*" for rule in ranked])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names_of_hosts = batch["host"].to_pylist()
            hosts = [host.encode() for host in names_of_hosts]
            in_words = [f".{host.translate(SEPARATORS)}.".encode() for host in names_of_hosts]
            paths = [path.encode() for path in batch["path"].to_pylist()]
            on_host = by_host.matches(hosts)
            of_rules = on_host.reshape(len(hosts), len(ranked), 2)
            found = of_rules.any(axis=2) & by_path.matches(paths)
            # A last column that always fits: no rule.
            first = np.column_stack([found, np.ones(len(hosts), dtype=bool)]).argmax(axis=1)
            fits = first < len(ranked)
            bad = by_words.matches(in_words).any(axis=1)
            bad |= np.array([not host for host in hosts], dtype=bool)
            names = [ranked[i].name if fit else None for i, fit in zip(first, fits)]
            verdicts = [
                ranked[i].verdict if fit else BLOCK if blocked else ALLOW
                for i, fit, blocked in zip(first, fits, bad)
            ]
            columns = {name: batch[name] for name in batch.schema.names}
            columns["rule"] = pa.array(names, pa.string())
            columns["verdict"] = pa.array(verdicts, pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    return judge


def filter_urls(
    pages: DataFrame,
    rules: tuple[UrlRule, ...] = RULES,
    blocked_hosts: tuple[str, ...] = BLOCKED_HOSTS,
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    Host and path of a null url, or one without ``://``, are empty. A rule fits
    its host and all subdomains if the path starts with the rule's path; the
    longest that fits gives the verdict. Where none fits, rule is null and the
    verdict is ``block`` for hosts that a glob of ``blocked_hosts`` fits and for empty
    hosts, else ``allow``. Those globs see the host with ``-``, ``_`` and ``:`` as dots
    and a dot at both ends: ``*.pills.*`` fits a whole word anywhere. Equal urls get
    equal rows. Only page_id and url are read.
    """
    after = F.expr("CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) ELSE '' END")
    parts = pages.select("page_id", F.coalesce(after, F.lit("")).alias("rest")).select(
        "page_id",
        F.translate(
            F.regexp_extract("rest", r"^([^/?#]*)", 1),
            "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
            "abcdefghijklmnopqrstuvwxyz",
        ).alias("host"),
        F.regexp_extract("rest", r"^[^/?#]*([^?#]*)", 1).alias("path"),
    )
    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, " \
        "host string, path string, rule string, verdict string"
    return parts.mapInArrow(_judge(rules, blocked_hosts), schema)
