"""Text cleaning as Spark column expressions (CL1-CL7).

Every function maps ``Column -> Column`` and stays inside whole-stage codegen,
except :func:`normalize_unicode`, which is one Arrow-batched UDF.

Whitespace follows the definition the cleaned text was written against: the
29 code points for which a Python ``str.isspace()`` is true.  Java's ``\\s`` is
ASCII only and Spark's one-argument ``trim`` strips only the space, so the
class is spelled out.
"""

from __future__ import annotations

import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..batches import map_parts

# The whitespace code points (Python ``str.isspace``), as ranges.
WS_RANGES = [(0x09, 0x0D), (0x1C, 0x1F), (0x20, 0x20), (0x85, 0x85),
             (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
             (0x2028, 0x2028), (0x2029, 0x2029), (0x202F, 0x202F),
             (0x205F, 0x205F), (0x3000, 0x3000)]

# Control characters removed by the cleaner (tab, LF, CR kept).
CONTROL_RANGES = [(0x00, 0x08), (0x0B, 0x0C), (0x0E, 0x1F), (0x7F, 0x9F)]

# Header and date markers of the crawled article layout.
PUBLISHED = "Published"
UPDATE_SUFFIX = "Update on GitHub"


def _class(ranges, without: int | None = None) -> str:
    """A regex class of code point ranges, one code point left out."""
    out = []
    for lo, hi in ranges:
        if without is None or not lo <= without <= hi:
            out.append((lo, hi))
        else:
            out += [(a, b) for a, b in ((lo, without - 1), (without + 1, hi)) if a <= b]
    return "[" + "".join(f"\\x{{{lo:X}}}-\\x{{{hi:X}}}" for lo, hi in out) + "]"


WS_CHARS = "".join(chr(c) for lo, hi in WS_RANGES for c in range(lo, hi + 1))
WS = _class(WS_RANGES)
WS_NO_LF = _class(WS_RANGES, without=0x0A)
CONTROL = _class(CONTROL_RANGES)

# The cleaner's patterns, in a form valid in both Java regex and
# RE2 (no lookaround), see oracle SQL.
# TRAILING_WS_RE is the per-line right strip as one regex; the Spark side
# splits lines instead (cheaper), the DuckDB oracle uses the regex.
DATE_RE = f"{PUBLISHED}{WS}+([^\\n]*?)(?:{WS}+{UPDATE_SUFFIX})?\\n"
HEADER_RE = f"(?s)\\A(.*?\\n+{PUBLISHED}{WS}+.*?(?:{WS}+{UPDATE_SUFFIX})?\\n)"
# (?d): only LF ends a line, as in the cleaned text's line model.
HEADING_RE = f"(?dm)^#{{1,6}}{WS}+"
MARKUP_RES = [r"\*\*([^*]+)\*\*", r"__([^_]+)__", r"\*([^*]+)\*", r"_([^_]+)_"]
MARKUP_MARKERS = ["*", "_", "*", "_"]
TRAILING_WS_RE = f"{WS_NO_LF}+(\\n|\\z)"


def _ws_strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WS_CHARS))


def extract_date(text: Column) -> Column:
    """CL1: first ``Published <date>`` followed by a newline; ``""`` if none."""
    return _ws_strip(F.regexp_extract(text, DATE_RE, 1))


def remove_header(text: Column) -> Column:
    """CL2: drop title and ``Published`` line, then strip; else unchanged."""
    head = F.regexp_extract(text, HEADER_RE, 1)
    return F.when(F.length(head) > 0,
                  _ws_strip(F.substring(text, F.length(head) + 1, 2147483647))
                  ).otherwise(text)


@F.arrow_udf(StringType())
def _nfkc(texts: pa.Array) -> pa.Array:
    # pyarrow's utf8_normalize(form="NFKC") returns decomposed text in the
    # pinned pyarrow, so the standard library does the work.  ASCII rows,
    # which NFKC never changes, are found vectorised and passed through.
    def normal(part: pa.Array) -> pa.Array:
        ascii_mask = pc.fill_null(pc.string_is_ascii(part), True)
        if pc.all(ascii_mask).as_py():
            return part
        return pa.array([v if ok else unicodedata.normalize("NFKC", v)
                         for v, ok in zip(part.to_pylist(), ascii_mask.to_pylist())], type=pa.string())

    return map_parts(texts, normal, pa.string())


def normalize_unicode(text: Column) -> Column:
    """CL3: NFKC.  The only step that leaves the JVM (Arrow batches)."""
    return _nfkc(text)


def remove_control_chars(text: Column) -> Column:
    """CL4: delete C0/C1 controls except tab, LF and CR."""
    return F.regexp_replace(text, CONTROL, "")


def _guarded(text: Column, marker: str, pattern: str, repl: str) -> Column:
    """``regexp_replace`` only on rows holding the pattern's marker
    character; every pattern here needs its marker to match, so skipping the
    other rows changes nothing and saves the regex pass.

    The input is referenced three times, so a guarded step must read a
    column, not a nested expression: steps are applied as successive
    projections (:func:`apply_steps`), which Catalyst keeps apart because
    collapsing them would duplicate the expensive producer."""
    return F.when(F.instr(text, marker) > 0, F.regexp_replace(text, pattern, repl)).otherwise(text)


def _markdown_steps():
    steps = [lambda t: _guarded(t, "#", HEADING_RE, "")]
    for marker, pat in zip(MARKUP_MARKERS, MARKUP_RES):
        steps.append(lambda t, m=marker, p=pat: _guarded(t, m, p, "$1"))
    return steps


def _rstrip_lines(text: Column) -> Column:
    lines = F.transform(F.split(text, "\n", -1), lambda line: F.rtrim(line, F.lit(WS_CHARS)))
    return F.array_join(lines, "\n")


def _whitespace_steps():
    return [lambda t: _guarded(t, "\n\n\n", "\n{3,}", "\n\n"),
            lambda t: _guarded(t, "  ", " {2,}", " "),
            lambda t: _ws_strip(_rstrip_lines(t))]


MARKDOWN_STEPS = _markdown_steps()
WHITESPACE_STEPS = _whitespace_steps()


def clean_markdown(text: Column) -> Column:
    """CL5 as one expression: headings at line start, then bold/italic
    markers, in that order (unguarded; for tables use :data:`MARKDOWN_STEPS`)."""
    out = F.regexp_replace(text, HEADING_RE, "")
    for pat in MARKUP_RES:
        out = F.regexp_replace(out, pat, "$1")
    return out


def normalize_whitespace(text: Column) -> Column:
    """CL6 as one expression: 3+ LF -> 2, 2+ spaces -> 1, strip each line's
    end, strip (for tables use :data:`WHITESPACE_STEPS`)."""
    out = F.regexp_replace(text, "\n{3,}", "\n\n")
    out = F.regexp_replace(out, " {2,}", " ")
    return _ws_strip(_rstrip_lines(out))


def clean_steps(nfkc: bool = True) -> list:
    """CL7 text part as steps: CL2 -> CL3 -> CL4 -> CL5 -> CL6."""
    steps = [remove_header]
    if nfkc:
        steps.append(normalize_unicode)
    steps.append(remove_control_chars)
    return steps + MARKDOWN_STEPS + WHITESPACE_STEPS


def apply_steps(df: DataFrame, column: str, steps, out: str | None = None) -> DataFrame:
    """Apply ``steps`` (Column -> Column) to ``column`` as successive
    projections, writing ``out`` (default: in place)."""
    out = out or column
    df = df.withColumn(out, steps[0](F.col(column)))
    for step in steps[1:]:
        df = df.withColumn(out, step(F.col(out)))
    return df
