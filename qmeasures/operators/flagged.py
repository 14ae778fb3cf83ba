"""Flags of many components in one pass over claim lines.

A *request* names a component of a measure in one of the code tables.  All requests of a run are
answered by one scan of the code columns, and lines without any listed code end there.

**Few codes** (up to ``LITERAL_FLAGS`` components and ``literal_codes`` rows in all lists together):
hashed literal sets.  A line is
tested against the union of all lists first, so the components' own tests run on lines
that can have a flag only.

**Many codes**: a join.  The code rows become one table ``(slot, code) -> bit words``; a slot is
a kind of claim column (procedure code, revenue code, first diagnosis, later diagnoses, ...).
The code columns of a line are exploded to (slot, code) pairs, meet that table, and are
folded back to the line with ``bit_or``:

* no code list reaches the driver or becomes a literal, however long it is; the driver reads
  the *structure* only (measure, component, code system, group, position);
* the code table is written first, so its size is known: Catalyst broadcasts it when it is
  small and shuffles both sides when it is not;
* the lookup is a hash probe inside generated code, once a code, for all components together;
* lines without a match end at the join, and the fold's key is the line, so neither a large
  member nor a frequent code gathers rows;
* what is written for several readers are the bit words, and a reader tests the bits of the
  flags it uses: the tests of some 60 components in one method stay above what the JVM compiles;
* a reader's lines are found by one mask over the words.  An OR of its flags would do, but Spark
  derives a constraint for every subset of the flags that such a filter and a projection share.

Rules of the predicates (ungrouped rows OR-ed, groups AND-ed over code systems, diagnosis
positions, versioned lists) are those of :mod:`qmeasures.functions.codes`.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from qmeasures.functions.codes import (_DIAG_VERSION, _NO_CLAIM_COLUMN, _SINGLE_COLUMN, CodeRow, CodeTableError, _numbered,
                                       any_versioned_diag, predicate_from_rows)
from qmeasures.operators.reuse import materialize

LITERAL_CODES = 2_000  # code rows that may become literals of a plan
LITERAL_FLAGS = 24     # components whose tests fit one generated method that the JVM still compiles
WORD_BITS = 62  # bits used of a long
_SPACE = " \t\r\n\f\v"


@dataclass(frozen=True)
class FlagRequest:
    """A component whose flag is wanted.

    ``systems`` keeps only rows of these code systems; ``versioned`` makes it a lookup of
    (diagnosis, ICD version), whose keys must be unique; ``only`` names the code systems that
    a versioned list may use at all.
    """

    table: str
    measure: str
    component: str
    systems: tuple[str, ...] = ()
    versioned: bool = False
    only: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        """Column name of the flag."""
        extra = "".join(["/" + "+".join(sorted(self.systems)) if self.systems else "", "/version" if self.versioned else ""])
        return f"{self.table}/{self.measure}/{self.component}{extra}".lower().replace(".", "_")


def _slots(system: str, position: str, columns: set[str], diags: list[str], procs: list[str]) -> list[str]:
    """The slots in which a code of this system is looked for."""
    if system in _SINGLE_COLUMN:
        return [_SINGLE_COLUMN[system]] if _SINGLE_COLUMN[system] in columns else []
    if system == "MODIFIER":
        return ["modifier"]
    if system.endswith("-DIAG"):
        found = {"primary": ["diag1"], "secondary": ["diag2"]}.get(position, ["diag1", "diag2"])
        return [s for s, there in (("diag1", diags[:1]), ("diag2", diags[1:])) if s in found and there]
    if system.endswith("-PROC"):
        return ["proc"] if procs else []
    if system in _NO_CLAIM_COLUMN:
        return []
    raise CodeTableError(f"code system {system!r} is not known")


def _listed(tables: dict[str, DataFrame], requests: list[FlagRequest]) -> DataFrame:
    """Normalised code rows of the requests' components."""
    parts = []
    for name in sorted({r.table for r in requests}):
        codes = tables[name]
        text = lambda c: F.coalesce(F.btrim(F.col(c).cast("string"), F.lit(_SPACE)), F.lit("")) \
            if c in codes.columns else F.lit("")  # noqa: E731, B023
        wanted = sorted({(r.measure.strip().lower(), r.component.strip().lower()) for r in requests if r.table == name})
        key = F.struct(F.lower(text("measure")), F.lower(text("component")))
        parts.append(codes.where(key.isin([F.struct(F.lit(m), F.lit(c)) for m, c in wanted])).select(
            F.lit(name).alias("table"), F.lower(text("measure")).alias("measure"), F.lower(text("component")).alias("component"),
            F.upper(text("codesystem")).alias("system"), F.btrim(F.col("code").cast("string"), F.lit(_SPACE)).alias("code"), text("grouping_id").alias("grp"),
            F.lower(text("diag_type")).alias("position")))
    return reduce(DataFrame.unionByName, parts)


def _check_versioned(rows: DataFrame, requests: list[FlagRequest]) -> None:
    """The keys (code, version) of a versioned list must be unique; one example of each faulty list is read."""
    lists = {(r.table, r.measure.strip().lower(), r.component.strip().lower()) for r in requests if r.versioned}
    if not lists:
        return
    twice = (rows.where(F.col("system").isin(list(_DIAG_VERSION))).groupBy("table", "measure", "component", "system", "code")
             .agg(F.count(F.lit(1)).alias("n")).where("n > 1").groupBy("table", "measure", "component").agg(F.min("code").alias("code")))
    for t in twice.collect():
        if (t.table, t.measure, t.component) in lists:
            raise CodeTableError(f"{t.measure}/{t.component}: a version lists {t.code!r} more than once")


def flag_lines(claims: DataFrame, tables: dict[str, DataFrame], requests, keep,
               literal_codes: int = LITERAL_CODES, write: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Lines of ``claims`` with at least one listed code: the ``keep`` columns and a boolean per request.

    Columns of requests are named :attr:`FlagRequest.name` and never NULL.  Repeated lines stay
    repeated.  A line whose code is in the wrong position, or in a group that isn't complete, may
    come with all flags false.  ``literal_codes`` bounds what the driver reads.  ``write`` stores the
    lines: in a join it gets their bit words, and each reader tests the bits of its own flags.
    """
    requests = sorted(set(requests), key=lambda r: r.name)
    return flag_reader(claims, tables, requests, keep, literal_codes, write)(requests)


def flag_reader(claims: DataFrame, tables: dict[str, DataFrame], requests, keep, literal_codes: int = LITERAL_CODES,
                write: Callable[[DataFrame], DataFrame] | None = None) -> Callable[[list[FlagRequest]], DataFrame]:
    """As :func:`flag_lines`; what is returned gives the lines of some of the requests, with their flags."""
    requests = sorted(set(requests), key=lambda r: r.name)
    held = [c for c in keep if c in claims.columns]
    listed = _listed(tables, requests)
    few = listed.limit(literal_codes + 1).collect() if len(requests) <= LITERAL_FLAGS else None
    if few is not None and len(few) <= literal_codes:
        found = _by_literals(claims, few, requests, held)
        found = write(found) if write else found
        return lambda some: found.select(*held, *[F.col(f"`{r.name}`") for r in some])
    return _by_join(claims, materialize(listed), requests, held, write)


def _of(rows, r: FlagRequest) -> list:
    """The request's own rows among collected ones; code systems that it may not use raise."""
    own = [s for s in rows if (s.table, s.measure, s.component) ==
           (r.table, r.measure.strip().lower(), r.component.strip().lower())]
    wrong = sorted({s.system for s in own} - {x.upper() for x in r.only}) if r.only else []
    if wrong:
        raise CodeTableError(f"{r.measure}/{r.component}: code systems {wrong} are not supported in this list")
    return [s for s in own if not r.systems or s.system in {x.upper() for x in r.systems}]


def _by_literals(claims: DataFrame, rows: list, requests: list[FlagRequest], held: list[str]) -> DataFrame:
    flags, union = [], {}
    for r in requests:
        own = [CodeRow(s.system, s.code, s.grp or None, s.position or None) for s in _of(rows, r) if s.code is not None]
        if r.versioned:
            by_version: dict[str, list[str]] = {}
            for x in own:
                if x.codesystem in _DIAG_VERSION:
                    by_version.setdefault(_DIAG_VERSION[x.codesystem], []).append(x.code)
            for version, codes in by_version.items():
                if len(set(codes)) < len(codes):
                    raise CodeTableError(f"{r.measure}/{r.component}: version {version} lists a code more than once")
            flags.append(any_versioned_diag(claims.columns, by_version).alias(r.name))
        else:
            flags.append(predicate_from_rows(own, claims.columns).alias(r.name))
        for x in own:  # any position and no groups: what all components' codes have in common
            union[x.codesystem, x.code] = CodeRow(x.codesystem, x.code, None, None)
    # one test of each kind of column against all codes, before the tests of the components
    listed = predicate_from_rows(list(union.values()), claims.columns)
    return claims.filter(listed).select(*held, *flags)


def _by_join(claims: DataFrame, rows: DataFrame, requests: list[FlagRequest], held: list[str],
             write: Callable[[DataFrame], DataFrame] | None = None) -> Callable[[list[FlagRequest]], DataFrame]:
    names = set(claims.columns)
    diags, procs = _numbered(claims.columns, "icddiag"), _numbered(claims.columns, "icdproc")
    # the shape of the lists, not the codes: a few rows per component
    shape = rows.select("table", "measure", "component", "system", "grp", "position").distinct().collect()
    _check_versioned(rows, requests)
    bits: dict[tuple, int] = {}
    wires, terms = [], {}  # (shape row, slot, bit); request -> its condition over bits
    for r in requests:
        groups: dict[str, dict[str, set]] = {}
        for s in sorted(_of(shape, r), key=str):
            if r.versioned:
                if s.system not in _DIAG_VERSION:
                    continue
                group, part, position = "", _DIAG_VERSION[s.system], ""
            else:
                # rows without a group need one bit together, a group one for each code system
                group, part, position = s.grp, s.system if s.grp else "", s.position
            key = (r, group, part)
            bit = bits.setdefault(key, len(bits))
            groups.setdefault(group, {}).setdefault(part, set()).add(bit)
            for slot in _slots(s.system, position, names, diags, procs):
                wires.append((s.table, s.measure, s.component, s.system, s.grp, s.position, slot, bit))
        terms[r] = groups
    spark = claims.sparkSession
    n_words = max(1, -(-len(bits) // WORD_BITS))
    wired = spark.createDataFrame(
        [(*w[:7], *[1 << (w[7] % WORD_BITS) if w[7] // WORD_BITS == k else 0 for k in range(n_words)]) for w in wires],
        "table string, measure string, component string, system string, grp string, position string, slot string"
        + "".join(f", w{k} long" for k in range(n_words)))
    words = [f"w{k}" for k in range(n_words)]
    # one row per slot and code: the broadcast's size is the number of codes
    lookup = materialize(rows.join(wired, ["table", "measure", "component", "system", "grp", "position"])
                         .groupBy("slot", "code").agg(*[F.bit_or(w).alias(w) for w in words]))
    slots = [(c, c) for c in sorted(set(_SINGLE_COLUMN.values()) & names)]
    slots += [("modifier", c) for c in ("modifier", "modifier2") if c in names]
    slots += [("diag1" if k == 0 else "diag2", c) for k, c in enumerate(diags)] + [("proc", c) for c in procs]
    used = {w[6] for w in wires}
    slots = [(s, c) for s, c in slots if s in used]
    if not slots:
        return lambda some: claims.where("false").select(*held, *[F.lit(False).alias(r.name) for r in some])
    place = F.array(*[F.lit(s) for s, _ in slots])
    kept, held = held, held + [c for c in ["icdversion"] if c in names and c not in held]
    # the line gets its number before its codes are exploded
    numbered = claims.select(F.monotonically_increasing_id().alias("_line"), *held,
                             F.array(*[F.col(c).cast("string") for _, c in slots]).alias("_codes"))
    pairs = (numbered.select("_line", *held, F.posexplode("_codes").alias("_at", "code")).where(F.col("code").isNotNull()).withColumn("slot", F.element_at(place, F.col("_at") + 1)))
    folded = (pairs.join(lookup, ["slot", "code"]).groupBy("_line", *held)
              .agg(*[F.bit_or(w).alias(w) for w in words]))
    if write:
        # the tests of all components together make a generated method that the JVM won't compile
        folded = write(folded.select(*held, *words))

    def on(bit: int) -> Column:
        return F.col(words[bit // WORD_BITS]).bitwiseAND(F.lit(1 << (bit % WORD_BITS))) != 0

    def condition(r: FlagRequest) -> Column:
        out = F.lit(False)
        for group, parts in sorted(terms[r].items()):
            each = {part: reduce(lambda a, b: a | b, [on(b) for b in sorted(found)]) for part, found in parts.items()}
            if r.versioned:
                if "icdversion" in names:
                    for version, hit in sorted(each.items()):
                        out = out | (hit & F.coalesce(F.col("icdversion") == version, F.lit(False)))
            elif group:
                out = out | reduce(lambda a, b: a & b, each.values())
            else:
                out = out | each[""]
        return out

    def read(some: list[FlagRequest]) -> DataFrame:
        own = {bit for r in some for parts in terms[r].values() for found in parts.values() for bit in found}
        masks = [sum(1 << (bit % WORD_BITS) for bit in own if bit // WORD_BITS == k) for k in range(n_words)]
        hit = [F.col(w).bitwiseAND(F.lit(m)) != 0 for w, m in zip(words, masks) if m]
        lines = folded if own == set(bits.values()) else folded.where(reduce(lambda a, b: a | b, hit, F.lit(False)))
        return lines.select(*kept, *[condition(r).alias(r.name) for r in some])
    return read
