"""Secret scans, in SQL functions only.

Three fixed patterns give the base spans. The method adds spans of high entropy: over every candidate
string of a character class a window slides by one character; the counts of the characters in it are
changed by the one that leaves and the one that enters, and with them the sum of c * log2(c), from
which the window's Shannon entropy follows. A span reaches from the first window at or above the
class's limit to the end of the last. Candidates that an allow-list pattern matches are suppressed.

Spans count code points, the end is exclusive. Defined results: a null text counts as empty and has
no spans; spans of different kinds may overlap; repeated rows are scanned alike.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.columns import let

# Fixed values of the contract, in the order of the kinds. Longer runs than the least length match
# where the shorter pattern with a length check would: a run's first match takes the whole run.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"

# Sums of c * log2(c) are kept as whole multiples of 2^-32, so that they never drift.
_UNIT = float(1 << 32)


@dataclass(frozen=True)
class CharacterClass:
    """Candidates are maximal runs of `pattern`; `bits` is the entropy that makes a window hot."""

    name: str
    pattern: str
    window: int
    bits: float


CLASSES = (
    CharacterClass("entropy_hex", r"[0-9a-fA-F]{20,}", 20, 3.0),
    CharacterClass("entropy_base64", r"[A-Za-z0-9+/_-]{24,}", 24, 3.9),
)

# Whole candidates that are no secrets: words, paths and hyphenated names without digits; numbers;
# identifiers in the 8-4-4-4-12 form; well-known placeholders.
ALLOWED = (
    r"[A-Za-z/_+-]+",
    r"[0-9/_+-]+",
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
    r"(?i).*(example|placeholder|changeme|dummy).*",
)


def _running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Running sums or maxima of a non-empty array of ints that are not negative.

    Blocks of about the square root of the length bound the work to length ** 1.5.
    """
    zero = F.lit(0)

    def total(part: Column) -> Column:
        return F.aggregate(part, zero, combine)

    def by_width(width: Column) -> Column:
        blocks = F.transform(
            F.sequence(zero, F.floor((F.size(values) - 1) / width).cast("int")),
            lambda b: total(F.slice(values, b * width + 1, width)),
        )
        return let(
            let(blocks, lambda sums: F.transform(sums, lambda _, b: total(F.slice(sums, F.lit(1), b)))),
            lambda firsts: F.transform(
                values,
                lambda _, i: combine(
                    F.get(firsts, F.floor(i / width).cast("int")),
                    total(F.slice(values, i - i % width + 1, i % width + 1)),
                ),
            ),
        )

    return let(F.ceil(F.sqrt(F.size(values))).cast("int"), by_width)


_NO_SPANS = "array<struct<start:int,end:int,found:string,inner:string>>"


def located(text: Column, pattern: str, group: int = 0) -> Column:
    """All leftmost matches: array of (start, end, found, inner), inner being the group's text."""
    regex = F.lit(pattern)

    def of(cut: Column) -> Column:
        steps = F.transform(
            cut["found"], lambda m, i: F.length(m) + F.length(F.get(cut["between"], i))
        )
        ends = let(steps, lambda s: _running(s, lambda a, b: a + b))
        return let(
            ends,
            lambda e: F.transform(
                cut["found"],
                lambda m, i: F.struct(
                    (F.get(e, i) - F.length(m)).alias("start"),
                    F.get(e, i).alias("end"),
                    m.alias("found"),
                    F.get(cut["inner"], i).alias("inner"),
                ),
            ),
        )

    cut = F.struct(
        F.split(text, pattern, -1).alias("between"),
        F.regexp_extract_all(text, regex, F.lit(0)).alias("found"),
        F.regexp_extract_all(text, regex, F.lit(group)).alias("inner"),
    )
    return F.when(F.rlike(text, regex), let(cut, of)).otherwise(F.array().cast(_NO_SPANS))


def hot_range(candidate: Column, window: int, bits: float) -> Column:
    """Struct (first, last): start of the first hot window and end of the last; null if none."""
    weights = [0] + [round(c * math.log2(c) * _UNIT) for c in range(1, window + 1)]
    # Entropy of a window: log2(window) - sum / window.
    most = math.floor((math.log2(window) - bits) * window * _UNIT)
    weight = F.array(*[F.lit(w).cast("long") for w in weights])

    def slide(known: Column) -> Column:
        codes = known["codes"]

        def step(state: Column, i: Column) -> Column:
            entering = F.get(codes, i)
            leaving = F.when(i >= window, F.get(codes, i - window)).otherwise(F.lit(-1))

            def moved(pair: Column) -> Column:
                """pair: counts of the leaving character, and of the entering one without it."""
                lost = F.when(
                    leaving >= 0, F.get(weight, pair["out"] - 1) - F.get(weight, pair["out"])
                ).otherwise(F.lit(0).cast("long"))
                won = F.get(weight, pair["into"] + 1) - F.get(weight, pair["into"])

                def told(sum_: Column) -> Column:
                    hot = (i >= window - 1) & (sum_ <= F.lit(most))
                    return F.struct(
                        F.transform(
                            state["counts"],
                            lambda c, j: c
                            + F.when(j == entering, 1).otherwise(0)
                            - F.when(j == leaving, 1).otherwise(0),
                        ).alias("counts"),
                        sum_.alias("sum"),
                        F.when(hot & (state["first"] < 0), i - window + 1)
                        .otherwise(state["first"])
                        .alias("first"),
                        F.when(hot, i + 1).otherwise(state["last"]).alias("last"),
                    )

                return let(state["sum"] + lost + won, told)

            counts = F.struct(
                F.get(state["counts"], leaving).alias("out"),
                (
                    F.get(state["counts"], entering) - F.when(entering == leaving, 1).otherwise(0)
                ).alias("into"),
            )
            return let(counts, moved)

        start = F.struct(
            F.transform(known["alphabet"], lambda _: F.lit(0)).alias("counts"),
            F.lit(0).cast("long").alias("sum"),
            F.lit(-1).alias("first"),
            F.lit(-1).alias("last"),
        )
        return F.aggregate(
            F.sequence(F.lit(0), F.size(codes) - 1),
            start,
            step,
            lambda s: F.when(s["first"] >= 0, F.struct(s["first"].alias("first"), s["last"].alias("last"))),
        )

    def coded(characters: Column) -> Column:
        return let(
            F.array_distinct(characters),
            lambda alphabet: let(
                F.struct(
                    alphabet.alias("alphabet"),
                    F.transform(
                        characters, lambda ch: (F.array_position(alphabet, ch) - 1).cast("int")
                    ).alias("codes"),
                ),
                slide,
            ),
        )

    characters = F.filter(F.split(candidate, ""), lambda ch: ch != "")
    return F.when(F.length(candidate) >= window, let(characters, coded))


def entropy_spans(text: Column, kind: CharacterClass, allowed: tuple[str, ...] = ALLOWED) -> Column:
    """Array of (start, end) of the hot ranges of a class's candidates."""
    allow = "|".join(f"(?:{p})" for p in allowed)
    candidates = F.filter(
        located(text, kind.pattern), lambda s: ~F.rlike(s["found"], F.lit(f"^(?:{allow})$"))
    ) if allowed else located(text, kind.pattern)
    ranged = F.transform(
        candidates,
        lambda s: F.struct(
            s["start"].alias("start"), hot_range(s["found"], kind.window, kind.bits).alias("hot")
        ),
    )
    return F.transform(
        F.filter(ranged, lambda s: s["hot"].isNotNull()),
        lambda s: F.struct(
            (s["start"] + s["hot"]["first"]).alias("start"),
            (s["start"] + s["hot"]["last"]).alias("end"),
        ),
    )


def _of_kind(spans: Column, place: int, name: str) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"),
            F.lit(place).alias("place"),
            s["end"].alias("end"),
            F.lit(name).alias("kind"),
        ),
    )


def with_spans(rows: DataFrame, text: str, classes: tuple[CharacterClass, ...] = CLASSES,
               allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """Add `base` and `spans`: arrays of (start, place, end, kind) by start, then kind."""
    column = F.coalesce(F.col(text), F.lit(""))
    assign = F.filter(located(column, ASSIGN, 2), lambda s: F.length(s["inner"]) >= ASSIGN_LEAST)
    base = F.concat(
        _of_kind(assign, 0, "assign"),
        _of_kind(located(column, ACCESS), 1, "access"),
        _of_kind(located(column, HEX), 2, "hex"),
    )
    added = F.concat(
        *[
            _of_kind(entropy_spans(column, kind, allowed), 3 + n, kind.name)
            for n, kind in enumerate(classes)
        ]
    )
    return (
        rows.withColumn("base", F.array_sort(base))
        .withColumn("_added", added)
        .withColumn("spans", F.array_sort(F.concat("base", "_added")))
        .drop("_added")
    )


def as_text(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def redacted(text: Column, spans: Column, marker: str = "[secret]") -> Column:
    """The text with every span, or every group of overlapping spans, replaced by `marker`."""

    def of(covered: Column) -> Column:
        """covered: furthest end of the spans up to each."""
        pieces = F.transform(
            spans,
            lambda s, i: let(
                F.coalesce(F.get(covered, i - 1), F.lit(0)),
                lambda before: F.when(
                    (s["start"] >= before) | (i == 0),
                    F.concat(F.substring(text, before + 1, s["start"] - before), F.lit(marker)),
                ).otherwise(F.lit("")),
            ),
        )
        rest = F.substring(text, F.element_at(covered, -1) + 1, F.length(text))
        return F.concat(F.array_join(pieces, ""), rest)

    ends = F.transform(spans, lambda s: s["end"])
    return F.when(
        F.size(spans) > 0, let(let(ends, lambda e: _running(e, lambda a, b: F.greatest(a, b))), of)
    ).otherwise(text)


def scan_documents(docs: DataFrame) -> DataFrame:
    """Contract rows: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    found = with_spans(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")), "text"
    )

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(F.encode(as_text(F.col("base")), "utf-8"), 256).alias("base_sha256"),
        as_text(F.col("spans")).alias("spans"),
    )


def redact_documents(docs: DataFrame) -> DataFrame:
    """The documents with their secrets replaced and `n_chars` counted anew; all rows stay."""
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    found = with_spans(docs.select(*columns), "text")
    # A column of its own: under the name `text` a later expression of the same select would see it.
    cleaned = found.withColumn("_clean", redacted(F.col("text"), F.col("spans")))
    changed = F.size("spans") > 0
    return cleaned.select(
        "doc_id",
        F.col("_clean").alias("text"),
        "lang",
        "source",
        F.when(changed, F.length("_clean").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"),
    )
