"""Conditional-aggregate waterfalls over a distinct grid of dimensions.

A metric counts or sums rows of a source at a *role*: the columns of the row that form the cell
key (this month's cell, next month's cell, the cell of the cancellation month, the cell the
account left, ...). Conditions, values and keys are SQL expressions. Many metrics share one pass:

1. each source is grouped once by all columns its roles need. Partial aggregation keeps a hot
   cell to one row per task. Conditions on these columns alone (``Part.cell``) pick grouped rows, so terms
   that differ only in them share one sum;
2. each row of the small grouped result is repeated once per role it matters for;
3. all sources are unioned and grouped once by cell. Some roles also define which cells exist
   (the grid); cells that no such role touches are dropped, so the grid needs no join.

Distinct counts take a second path: every row gives one bit per metric it counts for, bits are
OR-ed per (cell, id) and then summed per cell. The id-level group has a state of a few integers.

Several waterfalls of one source can share a *cube*: the sums of all their measures by all columns that
their roles read, and one set of flags per such cell and id, which tells what conditions any row of the
id met. Both merge: sums add up and flags are OR-ed (``Cube.merge``), so the counts of two loads come from
their cubes, without their rows. A flag word holds 62 conditions; there are as many words as needed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ONE = "1L"
#: Bits used of a 64-bit word.
WORD = 62


@dataclass(frozen=True)
class Role:
    """Where a source row lands in the grid.

    ``key``: an expression per dimension. ``grid``: rows for which this role makes a grid cell.
    """

    key: dict[str, str]
    grid: str | None = None


@dataclass(frozen=True)
class Part:
    """One term of a metric: rows of ``source`` where ``where`` holds, at ``role``.

    ``cell`` is a further condition that reads only columns by which the source is grouped.
    """

    source: str
    role: str
    where: str
    value: str = ONE  # one per row, that is a count
    sign: int = 1
    distinct: bool = False
    cell: str | None = None

    @property
    def test(self) -> str:
        """Both conditions."""
        return self.where if self.cell is None else f"({self.cell}) AND ({self.where})"


@dataclass(frozen=True)
class Metric:
    name: str
    parts: tuple[Part, ...]


@dataclass
class Source:
    """A frame, its roles, the columns the roles read and the id for distinct counts.

    ``one_pass`` takes sums and ids through one grouping, the sums without an id. It moves wider rows but
    reads the frame once, which pays where the frame is costly and has few sums.
    """

    frame: DataFrame
    roles: dict[str, Role]
    group: Sequence[str]
    id: str | None = None
    one_pass: bool = False
    #: With a cube ``frame`` has its sums and ``id_frame`` its ids, with any columns that the roles add.
    cube: Cube | None = None
    id_frame: DataFrame | None = None


def _measures(parts, name: str) -> dict[tuple[str, str], str]:
    """A column for every (condition, value); terms that differ only in role, sign or cells share one."""
    keys = dict.fromkeys((p.where, p.value) for p in parts if not p.distinct)
    return {key: f"{name}_{k}" for k, key in enumerate(keys)}


def _sum_columns(measures: dict[tuple[str, str], str]) -> list[Column]:
    return [
        F.expr(f"sum(CASE WHEN {where} THEN {value} END)").alias(column)
        for (where, value), column in measures.items()
    ]


def _words(tests: Sequence[str], prefix: str) -> list[tuple[str, str]]:
    """(name, expression) of the integers that hold one bit a test."""
    bits = [f"CASE WHEN {test} THEN {1 << k % WORD}L ELSE 0L END" for k, test in enumerate(tests)]
    groups = [bits[k : k + WORD] for k in range(0, len(bits), WORD)]
    return [(f"{prefix}{w}", " | ".join(group)) for w, group in enumerate(groups)]


def _bit(k: int, prefix: str) -> str:
    return f"shiftright({prefix}{k // WORD}, {k % WORD}) & 1L"


@dataclass
class Cube:
    """Sums of a source by ``group``, and flags by ``group`` and id; ``parts`` are the terms it serves."""

    parts: Sequence[Part]
    name: str
    group: Sequence[str]
    sums: DataFrame | None = None
    ids: DataFrame | None = None

    @property
    def measures(self) -> dict[tuple[str, str], str]:
        return _measures(self.parts, self.name)

    @property
    def flags(self) -> list[str]:
        return list(dict.fromkeys(p.test for p in self.parts if p.distinct))

    def sums_of(self, frame: DataFrame) -> DataFrame:
        return self._grouped(frame, _sum_columns(self.measures))

    def ids_of(self, frame: DataFrame, id: str) -> DataFrame:
        """Cells and ids that meet a condition at all."""
        words = _words(self.flags, "__flags")
        tagged = frame.withColumn("__id", F.expr(id)).where("__id IS NOT NULL")
        grouped = tagged.selectExpr(*self.group, "__id", *[f"{e} AS {n}" for n, e in words]).where(
            " OR ".join(f"{n} <> 0" for n, _ in words)
        )
        return self._joined(grouped)

    def _grouped(self, rows: DataFrame, sums: list[Column]) -> DataFrame:
        return rows.groupBy(*self.group).agg(*sums) if sums else rows.select(*self.group).distinct()

    def _joined(self, rows: DataFrame) -> DataFrame:
        words = [n for n, _ in _words(self.flags, "__flags")]
        return rows.groupBy(*self.group, "__id").agg(*[F.bit_or(n).alias(n) for n in words])

    def merge(self, other: Cube) -> Cube:
        """The cube of the rows of both.

        Ids are dealt by id alone, at most a row a cell and side: counts by other cells then find them in place.
        """
        added = [F.sum(c).alias(c) for c in self.measures.values()]
        sums = self._grouped(self.sums.unionByName(other.sums), added)
        ids = self._joined(self.ids.unionByName(other.ids).repartition("__id"))
        return Cube(self.parts, self.name, self.group, sums, ids)

    def test(self, where: str) -> str:
        return f"({_bit(self.flags.index(where), '__flags')}) = 1"


@dataclass
class _Piece:
    """Rows of (dims, __grid, __role, measures) and, per metric, the terms to add up."""

    rows: DataFrame
    terms: dict[str, list[tuple[int, str]]]


@dataclass
class Waterfall:
    dims: Sequence[str]
    metrics: Sequence[Metric]
    sources: dict[str, Source] = field(default_factory=dict)

    def build(self) -> DataFrame:
        """Grid cells with every metric, 0 where nothing contributes."""
        pieces, first_role = [], 0
        for name, source in self.sources.items():
            passes = (self._together,) if source.one_pass else (self._sums, self._distinct)
            for make in passes:
                piece = make(name, source, first_role)
                if piece is not None:
                    pieces.append(piece)
                first_role += len(source.roles)
        rows = pieces[0].rows
        for piece in pieces[1:]:
            rows = rows.unionByName(piece.rows, allowMissingColumns=True)
        known = " AND ".join(f"{d} IS NOT NULL" for d in self.dims)
        totals = []
        for m in self.metrics:
            terms = [t for p in pieces for t in p.terms.get(m.name, [])]
            cases = " ".join(f"WHEN __role = {role} THEN {value}" for role, value in terms)
            totals.append(F.expr(f"sum(CASE {cases} END)" if cases else "0L").alias(m.name))
        cells = rows.groupBy(*self.dims).agg(F.expr("bool_or(__grid)").alias("__grid"), *totals)
        return cells.where("__grid").selectExpr(
            *self.dims,
            *[f"coalesce(CASE WHEN {known} THEN {m.name} END, 0) AS {m.name}" for m in self.metrics],
        )

    def _parts(self, source: str, distinct: bool) -> list[tuple[str, Part]]:
        return [
            (m.name, part)
            for m in self.metrics
            for part in m.parts
            if part.source == source and part.distinct == distinct
        ]

    def _known(self, role: Role) -> str:
        return " AND ".join(f"({role.key[d]}) IS NOT NULL" for d in self.dims)

    def _sums(self, name: str, source: Source, first_role: int) -> _Piece | None:
        parts = self._parts(name, distinct=False)
        roles = list(source.roles.items())
        if not parts and not any(role.grid for _, role in roles):
            return None
        grid_tests = [(f"__g{k}", role.grid) for k, (_, role) in enumerate(roles) if role.grid]
        measures = _measures([p for _, p in parts], name)
        # A column for every (cells, condition, value).
        keys = dict.fromkeys((p.cell, p.where, p.value) for _, p in parts)
        columns = {key: f"{name}_c{k}" for k, key in enumerate(keys)}
        if source.cube is None:
            held, marks = measures, [F.expr(f"bool_or({test})").alias(mark) for mark, test in grid_tests]
            small = source.frame.groupBy(*source.group).agg(*marks, *_sum_columns(measures))
            marks = [mark for mark, _ in grid_tests]
        else:
            # Tests of the grid read cell columns only, so they hold for a cell as for its rows.
            held, small = source.cube.measures, source.frame
            marks = [f"({test}) AS {mark}" for mark, test in grid_tests]
        small = small.selectExpr(
            *source.group, *marks,
            *[
                f"{held[where, value]} AS {column}" if cell is None
                else f"CASE WHEN {cell} THEN {held[where, value]} END AS {column}"
                for (cell, where, value), column in columns.items()
            ],
        )
        guards, grids = [], []
        terms: dict[str, list[tuple[int, str]]] = {}
        for k, (role_name, role) in enumerate(roles):
            used = {}
            for metric, part in parts:
                if part.role == role_name:
                    column = columns[part.cell, part.where, part.value]
                    used.setdefault(metric, []).append((part.sign, column))
            for metric, signed in used.items():
                terms.setdefault(metric, []).append((first_role + k, _added(signed)))
            seen = dict.fromkeys(column for signed in used.values() for _, column in signed)
            touched = " OR ".join(f"{column} IS NOT NULL" for column in seen) or "FALSE"
            guard = f"({self._known(role)} AND ({touched}))"
            if role.grid:
                guard = f"coalesce(__g{k}, FALSE) OR {guard}"
                grids.append(f"WHEN {first_role + k} THEN coalesce(__g{k}, FALSE)")
            guards.append(guard)
        grid = f"CASE __role {' '.join(grids)} ELSE FALSE END" if grids else "FALSE"
        rows = self._fan_out(small, roles, guards, first_role, [*small.columns])
        return _Piece(
            rows.selectExpr(*self._dims_of(roles, first_role), f"{grid} AS __grid", "__role", *columns.values()),
            terms,
        )

    def _distinct(self, name: str, source: Source, first_role: int) -> _Piece | None:
        parts = self._parts(name, distinct=True)
        if not parts:
            return None
        roles, cube = list(source.roles.items()), source.cube
        test = (lambda p: p.test) if cube is None else (lambda p: cube.test(p.test))
        number = {role_name: first_role + k for k, (role_name, _) in enumerate(roles)}
        guards = []
        for role_name, role in roles:
            hits = [test(p) for _, p in parts if p.role == role_name]
            any_hit = " OR ".join(f"({w})" for w in hits) or "FALSE"
            guards.append(f"({self._known(role)}) AND ({any_hit})")
        words = _words([f"__role = {number[p.role]} AND ({test(p)})" for _, p in parts], "__bits")
        if cube is None:
            frame = source.frame.withColumn("__id", F.expr(source.id)).where("__id IS NOT NULL")
        else:
            frame = source.id_frame
        tagged = self._fan_out(frame, roles, guards, first_role, None).selectExpr(
            *self._dims_of(roles, first_role), "__id", *[f"{e} AS {n}" for n, e in words]
        )
        per_id = tagged.groupBy(*self.dims, "__id").agg(*[F.bit_or(n).alias(n) for n, _ in words])
        terms: dict[str, list[tuple[int, str]]] = {}
        sums = []
        for bit, (metric, part) in enumerate(parts):
            column = f"{name}_d{bit}"
            sums.append(F.expr(f"sum({_bit(bit, '__bits')})").alias(column))
            terms.setdefault(metric, []).append((part.sign, column))
        counts = per_id.groupBy(*self.dims).agg(*sums)
        rows = counts.selectExpr(
            *self.dims, "FALSE AS __grid", f"{first_role} AS __role",
            *[f"{name}_d{bit}" for bit in range(len(parts))],
        )
        return _Piece(rows, {m: [(first_role, _added(columns))] for m, columns in terms.items()})

    def _together(self, name: str, source: Source, first_role: int) -> _Piece:
        counted, summed = self._parts(name, distinct=True), self._parts(name, distinct=False)
        # Each role twice: for its sums, which leave the id and so shrink to a row a cell before they move,
        # and for its ids, which move without sums.
        roles = [pair for pair in source.roles.items() for _ in range(2)]
        sum_at = {role_name: first_role + 2 * k for k, role_name in enumerate(source.roles)}
        guards, grids = [], []
        for role_name, role in source.roles.items():
            known = self._known(role)
            sums, ids = (
                f"({known}) AND ({' OR '.join(f'({p.test})' for _, p in parts if p.role == role_name) or 'FALSE'})"
                for parts in (summed, counted)
            )
            guards += [f"({role.grid}) OR {sums}" if role.grid else sums, f"__id IS NOT NULL AND {ids}"]
            if role.grid:
                grids.append(f"WHEN {sum_at[role_name]} THEN coalesce({role.grid}, FALSE)")
        rows = self._fan_out(
            source.frame.withColumn("__id", F.expr(source.id)), roles, guards, first_role, None
        )
        words = _words([f"__role = {sum_at[p.role] + 1} AND ({p.test})" for _, p in counted], "__bits")
        values = [
            f"CASE WHEN __role = {sum_at[p.role]} AND ({p.test}) THEN {p.value} END AS {name}_{k}"
            for k, (_, p) in enumerate(summed)
        ]
        sums = [F.sum(f"{name}_{k}").alias(f"{name}_{k}") for k in range(len(summed))]
        per_id = (
            rows.selectExpr(
                *self._dims_of(roles, first_role),
                f"CASE WHEN (__role - {first_role}) % 2 = 1 THEN __id END AS __id",
                f"CASE __role {' '.join(grids)} ELSE FALSE END AS __grid" if grids else "FALSE AS __grid",
                *[f"{e} AS {n}" for n, e in words], *values,
            )
            .groupBy(*self.dims, "__id")
            .agg(F.bool_or("__grid").alias("__grid"), *[F.bit_or(n).alias(n) for n, _ in words], *sums)
        )
        counts = [
            F.expr(f"sum({_bit(bit, '__bits')})").alias(f"{name}_d{bit}")
            for bit in range(len(counted))
        ]
        cells = per_id.groupBy(*self.dims).agg(F.bool_or("__grid").alias("__grid"), *counts, *sums)
        terms: dict[str, list[tuple[int, str]]] = {}
        for bit, (metric, part) in enumerate(counted):
            terms.setdefault(metric, []).append((part.sign, f"{name}_d{bit}"))
        for k, (metric, part) in enumerate(summed):
            terms.setdefault(metric, []).append((part.sign, f"{name}_{k}"))
        return _Piece(
            cells.withColumn("__role", F.lit(first_role)),
            {m: [(first_role, _added(columns))] for m, columns in terms.items()},
        )

    def _fan_out(self, df, roles, guards, first_role, columns) -> DataFrame:
        """Repeat a row per role whose guard holds, tagged with the role number."""
        numbers = ", ".join(f"CASE WHEN {g} THEN {first_role + k} END" for k, g in enumerate(guards))
        kept = columns or ["*"]
        return df.selectExpr(*kept, f"explode(array({numbers})) AS __role").where("__role IS NOT NULL")

    def _dims_of(self, roles, first_role) -> list[str]:
        out = []
        for d in self.dims:
            keys = [role.key[d] for _, role in roles]
            if len(set(keys)) == 1:
                out.append(f"{keys[0]} AS {d}")
            else:
                whens = " ".join(f"WHEN {first_role + k} THEN {key}" for k, key in enumerate(keys))
                out.append(f"CASE __role {whens} END AS {d}")
        return out


def _added(columns: Sequence[tuple[int, str]]) -> str:
    """Signed sum of columns, nulls as 0; a single column keeps its null."""
    signed = [("-" if sign < 0 else "") + column for sign, column in columns]
    return signed[0] if len(signed) == 1 else " + ".join(f"coalesce({x}, 0)" for x in signed)
