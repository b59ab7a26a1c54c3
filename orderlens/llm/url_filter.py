r"""URL filters by a bit-parallel wildcard automaton.

All rules are packed into one Shift-And automaton: a pattern of m symbols takes
m + 1 neighbouring bits, bit j standing for "the first j symbols have matched".
One character c moves every rule at once,

    D' = ((D << 1) & MOVE[c]) | (D & STAY[c]),

where MOVE[c] holds the symbols that accept c and STAY[c] the states in front of
a wildcard run that accepts c.  D spans as many 64-bit words as the rules need,
the shift carrying between words; a batch of urls is advanced together, one
character position at a time, longest first, so that finished urls drop out.
The few urls that are far longer than the rest are finished one by one over a
single integer of all words.

Rules come in two kinds, both read by the same automaton over the canonical url
``.`` host path ``?query`` (scheme and fragment dropped, A-Z of the host
lower-cased):

* site rules (verdict, host, path): the host or any of its subdomains, the path
  by its start.  The longest host and path that fits wins (then the longer
  host, then the earlier rule) and gives the verdict;
* globs, for urls no site rule fits: ``?`` is one character, ``*`` a run without
  ``/`` and ``?``, ``**`` any run, a backslash takes the next character as it is.
  A url that a glob matches as a whole is blocked, any other allowed.

The judgement is one map over the url column: no shuffle, nothing collected.
The rule list is a parameter of the job and travels with it.

Defined cases: a null url and one without ``://`` have empty host and path, fit
no site rule and are judged by the globs over the empty text; characters count
by code points; very long urls are read whole; repeated rows give repeated
results, an empty table none; other columns play no part, and ``judge`` is a
column, so that none of the caller's can clash with it.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm.common import LOWER, UPPER, ascii_lower, table

#: (verdict, host, path)
SITES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: What to block among the urls that no site rule fits.
GLOBS = (
    "*cheap-pills**", "*free-bets**", "*spam-farm**", "*casino**", "*viagra**", "*.onion/**",
    "**/wp-login.php**", "**/cgi-bin/**", "**.exe", r"**.exe\?**", r"**\?**session???=**",
)
RESULT = "host string, path string, rule string, verdict string, pattern string"
BLOCK_CHARS = 1 << 20  # characters whose codes are held at a time
FEW = 8  # urls left over from a block that are finished one by one
NO_RUN = "/?"  # what a single star does not cross


def symbols(glob: str) -> list[str | None]:
    """A glob as a list: a character, None for any one, ``*`` and ``**`` as "*x" and "**x" runs."""
    out: list[str | None] = []
    for m in re.finditer(r"(?s)\\(.)|(\*\*+)|(\*)|(\?)|(.)", glob):
        literal, deep, run, one, char = m.groups()
        out.append("**run" if deep else "*run" if run else None if one else literal or char)
    return out


def site_symbols(host: str, path: str) -> list[str | None]:
    """The canonical url starts with a dot: "run, dot, host" is the host and its subdomains."""
    return ["*run", *f".{host}{path}", "**run"]


class Automaton:
    """Several patterns, each a list of symbols, simulated together."""

    def __init__(self, patterns: Sequence[Sequence[str | None]]):
        alphabet = sorted({c for p in patterns for c in p if c and len(c) == 1} | set(NO_RUN))
        self.classes = np.zeros(max(map(ord, alphabet)) + 2, dtype=np.int32)  # 0: in no pattern
        for k, c in enumerate(alphabet, 1):
            self.classes[ord(c)] = k
        chars = ["", *alphabet]
        move, stay, bit = [0] * len(chars), [0] * len(chars), 0
        self.start, self.final = 0, []
        for pattern in patterns:
            self.start |= 1 << bit
            for s in pattern:
                if s in ("*run", "**run"):
                    for k, c in enumerate(chars):
                        if s == "**run" or not c or c not in NO_RUN:
                            stay[k] |= 1 << bit
                    continue
                bit += 1
                for k, c in enumerate(chars):
                    if s is None or s == c:
                        move[k] |= 1 << bit
            self.final.append(bit)
            bit += 1
        self.move, self.stay, self.n_words = move, stay, max(1, -(-bit // 64))
        self.move_words, self.stay_words = self._words(move), self._words(stay)

    def _words(self, masks: list[int]) -> np.ndarray:
        raw = b"".join(m.to_bytes(8 * self.n_words, "little") for m in masks)
        return np.frombuffer(raw, dtype="<u8").reshape(len(masks), self.n_words)

    def _alone(self, codes: np.ndarray, state: int) -> int:
        move, stay = self.move, self.stay
        for at in range(0, len(codes), BLOCK_CHARS):
            for c in codes[at:at + BLOCK_CHARS].tolist():
                state = ((state << 1) & move[c]) | (state & stay[c])
        return state

    def _block(self, texts: list[str]) -> np.ndarray:
        """texts sorted by falling length -> final states, a row of words each."""
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        codes = self.classes[np.minimum(points, len(self.classes) - 1)]
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        state = np.repeat(self._words([self.start]), len(texts), axis=0)
        step, live = 0, int(np.count_nonzero(lengths))
        while live > FEW or (live and lengths[0] - step < 256):
            c, d = codes[starts[:live] + step], state[:live]
            moved = d << np.uint64(1)
            moved[:, 1:] |= d[:, :-1] >> np.uint64(63)
            state[:live] = (moved & self.move_words[c]) | (d & self.stay_words[c])
            step += 1
            live = int(np.searchsorted(-lengths, -step, side="left"))  # those longer than step
        for k in range(live):
            rest = codes[starts[k] + step:starts[k] + lengths[k]]
            ended = self._alone(rest, int.from_bytes(state[k].tobytes(), "little"))
            state[k] = self._words([ended])[0]
        return state

    def matches(self, texts: Sequence[str]) -> np.ndarray:
        """A row for each text, a boolean for each pattern: does it match the text as a whole."""
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        final = np.array(self.final, dtype=np.int64)
        out, at = np.zeros((len(texts), len(final)), dtype=bool), 0
        while at < len(order):
            width = max(1, BLOCK_CHARS // max(1, len(texts[order[at]])))
            some = order[at:at + width]
            state = self._block([texts[i] for i in some])
            bits = (state[:, final // 64] >> (final % 64).astype(np.uint64)) & np.uint64(1)
            out[some], at = bits.astype(bool), at + width
        return out


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path as the module states, both empty for a null url or one without ://."""
    part = lambda pattern: F.coalesce(F.regexp_extract(url, pattern, 1), F.lit(""))
    return ascii_lower(part(r"(?s)^.*?://([^/?#]*)")), part(r"(?s)^.*?://[^/?#]*([^?#]*)")


def judge(url: Column, sites: Sequence[tuple[str, str, str]] = SITES, globs: Sequence[str] = GLOBS) -> Column:
    """A struct (host, path, rule, verdict, pattern): the site rule or the first glob (pattern) that decides, else null."""
    sites = sorted(sites, key=lambda s: (len(s[1] + s[2]), len(s[1])), reverse=True)  # stable: earlier rules first
    automaton = Automaton([*(site_symbols(h, p) for _, h, p in sites), *([".", *symbols(g)] for g in globs)])
    verdicts = np.array([*(v for v, _, _ in sites), *["block"] * len(globs), "allow"], dtype=object)
    rules = np.array([*(h + p for _, h, p in sites), *[None] * (len(globs) + 1)], dtype=object)
    named = np.array([*[None] * len(sites), *globs, None], dtype=object)

    @F.arrow_udf(RESULT)
    def decide(host: pa.Array, path: pa.Array, query: pa.Array) -> pa.Array:
        hit = automaton.matches([f".{h}{p}{q}" for h, p, q in zip(host.to_pylist(), path.to_pylist(), query.to_pylist())])
        # the first pattern that matches, in the order of precedence; past the last: allowed
        first = np.where(hit.any(axis=1), hit.argmax(axis=1), hit.shape[1]) if hit.size else np.full(len(hit), hit.shape[1])
        text = lambda a: pa.array(a[first], pa.string())
        return pa.StructArray.from_arrays([host, path, text(rules), text(verdicts), text(named)],
                                          ["host", "path", "rule", "verdict", "pattern"])

    host, path = host_and_path(url)
    query = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^?#]*(\?[^#]*)", 1), F.lit(""))
    return decide(host, path, query)


def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", judge(F.col("url")).alias("judged")).select("page_id", "judged.*")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _regex(glob: str) -> str:
    runs = {"*run": "[^/?]*", "**run": ".*", None: "."}
    return "(?s)^" + "".join(runs.get(s) or re.escape(s) for s in symbols(glob)) + "$"


def _rule_cases() -> str:
    longest = sorted(SITES, key=lambda s: (len(s[1] + s[2]), len(s[1])), reverse=True)
    fits = [(f"(host = {_quoted(h)} OR ends_with(host, {_quoted('.' + h)})) AND starts_with(path, {_quoted(p)})", v, h + p)
            for v, h, p in longest]
    return (f"CASE {' '.join(f'WHEN {f} THEN {_quoted(r)}' for f, _, r in fits)} END AS rule, "
            f"CASE {' '.join(f'WHEN {f} THEN {_quoted(v)}' for f, v, _ in fits)} END AS ruled")


SQL = rf"""
WITH parts AS (
  SELECT page_id, coalesce(url, '') AS u, coalesce(strpos(url, '://'), 0) AS mark FROM pages
), rest AS (
  SELECT page_id, CASE WHEN mark > 0 THEN substr(u, mark + 3) ELSE '' END AS r FROM parts
), cut AS (
  SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(r, '^[^?#]*(\?[^#]*)', 1) AS query
  FROM rest
), ruled AS (
  SELECT page_id, host, path, host || path || query AS canonical, {_rule_cases()} FROM cut
), judged AS (
  SELECT *, CASE WHEN rule IS NULL THEN
    CASE {' '.join(f'WHEN regexp_matches(canonical, {_quoted(_regex(g))}) THEN {_quoted(g)}' for g in GLOBS)} END END AS pattern
  FROM ruled
)
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN pattern IS NULL THEN 'allow' ELSE 'block' END) AS verdict, pattern
FROM judged
"""
