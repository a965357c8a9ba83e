"""Nearest-place join: exact, by equality joins on grid cells."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsframe.operators.lookup import lookup_join
from obsframe.operators.position import with_position
from obsframe.workspace import materialize

FEW = 64           # so many query points are each compared with all places, in one pass
LEAF_PLACES = 64   # cells are split until none holds more distinct spots than this
STEP_BITS = 3      # a level's cells have 2**STEP_BITS of the next level's along each axis
MOST_BITS = 30


def _sum(terms: list[Column]) -> Column:
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


def _at_least(axes: list[str]) -> Column:
    """Squared distance to the box. Never above the distance to a spot in it, also after rounding."""
    gaps = [F.greatest(F.col(f"lo_{a}") - F.col(a), F.col(a) - F.col(f"hi_{a}"), F.lit(0.0)) for a in axes]
    return _sum([g * g for g in gaps])


def _at_most(axes: list[str]) -> Column:
    """Squared distance to the far corner of the box."""
    spans = [F.greatest(F.abs(F.col(a) - F.col(f"lo_{a}")), F.abs(F.col(a) - F.col(f"hi_{a}"))) for a in axes]
    return _sum([s * s for s in spans])


class _Grid:
    """Bounding boxes of the places at each level of a grid whose levels refine one another.

    The grid is laid over the ranks of the places along each axis, not over their values: its lines are quantiles. So
    one place far out widens a box, not all cells, and a cell holds few places as soon as it is a few ranks wide."""

    def __init__(self, spots: DataFrame, axes: list[str]):
        self.axes = axes
        self.cells = [f"cell_{a}" for a in axes]
        self.up = [f"up_{a}" for a in axes]
        spots = materialize(spots, "spots")
        self.empty = spots.isEmpty()
        if self.empty:
            return
        for a, c in zip(axes, self.cells):
            # Distinct values in order, so equal ones have one rank and their places one cell.
            ranks = with_position(spots.select(a).distinct(), [a])
            cell = F.floor(F.col("position") * F.lit(float(1 << MOST_BITS)) / F.col("total")).cast("long")
            spots = materialize(lookup_join(spots, materialize(ranks.select(a, cell.alias(c)), "ranks"), [a], stored=True), "spots")
        self.spots = spots
        self.bits = STEP_BITS
        while self._fullest() > LEAF_PLACES and self.bits < MOST_BITS:
            self.bits += STEP_BITS
        low, high = [F.min(a).alias(f"lo_{a}") for a in axes], [F.max(a).alias(f"hi_{a}") for a in axes]
        table = materialize(self.spots.groupBy(*self._coarser(MOST_BITS - self.bits)).agg(*low, *high), "boxes")
        self.levels = [self._under_parents(table)]
        low, high = [F.min(f"lo_{a}").alias(f"lo_{a}") for a in axes], [F.max(f"hi_{a}").alias(f"hi_{a}") for a in axes]
        for _ in range(self.bits // STEP_BITS - 1):
            table = materialize(table.groupBy(*self._coarser(STEP_BITS)).agg(*low, *high), "boxes")
            self.levels.insert(0, self._under_parents(table))

    def _coarser(self, bits: int) -> list[Column]:
        return [F.shiftright(c, bits).alias(c) for c in self.cells]

    def _fullest(self) -> int:
        return self.spots.groupBy(*self._coarser(MOST_BITS - self.bits)).count().agg(F.max("count")).first()[0]

    def _under_parents(self, table: DataFrame) -> DataFrame:
        """Each box with its parent's cell and its number among the parent's."""
        mask = F.lit((1 << STEP_BITS) - 1)
        number = _sum([F.shiftleft(F.col(c).bitwiseAND(mask), STEP_BITS * i) for i, c in enumerate(self.cells)])
        return table.withColumns({
            **{u: F.shiftright(c, STEP_BITS) for u, c in zip(self.up, self.cells)}, "child": number,
        })

    def at_top(self, points: DataFrame) -> DataFrame:
        return points.withColumns({u: F.lit(0).cast("long") for u in self.up})

    def down(self, points: DataFrame, *keep: str) -> DataFrame:
        """Make the cells of a level the parents of the next."""
        return points.select(*self.axes, *keep, *[F.col(c).alias(u) for u, c in zip(self.up, self.cells)])

    def guess(self, points: DataFrame, table: DataFrame) -> DataFrame:
        """Of the boxes under each point's parent, the one whose far corner is nearest."""
        best = lookup_join(points, table, self.up).groupBy(*self.axes, *self.up).agg(F.min_by("child", _at_most(self.axes)).alias("child"))
        mask = F.lit((1 << STEP_BITS) - 1)
        return best.select(*self.axes, *[
            (F.shiftleft(u, STEP_BITS) + F.shiftright("child", STEP_BITS * i).bitwiseAND(mask)).alias(c)
            for i, (u, c) in enumerate(zip(self.up, self.cells))
        ])

    def within(self, points: DataFrame, table: DataFrame) -> DataFrame:
        """All boxes under the parents that come within each point's reach."""
        return lookup_join(points, table, self.up).where(_at_least(self.axes) <= F.col("reach")).select(
            *self.axes, "reach", *self.cells
        )

    def candidates(self, points: DataFrame, key: str) -> DataFrame:
        """The spots of the cells of each point, with their distance."""
        leaf = self.spots.select(*self._coarser(MOST_BITS - self.bits), *[F.col(a).alias(f"at_{a}") for a in self.axes], key)
        gaps = [F.col(a) - F.col(f"at_{a}") for a in self.axes]
        return lookup_join(points, leaf, self.cells).withColumn("squared", _sum([g * g for g in gaps]))


def nearest_join(
    queries: DataFrame, places: DataFrame, axes: list[str], key: str, carry: list[str], squared: str = "squared_distance",
) -> DataFrame:
    """Add to each query the nearest place by Euclidean distance over ``axes``; the smallest ``key`` wins ties.

    Both sides have the columns ``axes``; ``key`` is unique in ``places``. Each distinct query point walks down a
    grid over the places twice. First it follows one promising cell per level to some place, whose distance
    is its reach. Then it follows all cells within reach, and takes the nearest of the places it ends up
    with. So points meet only the few cells around them, and dense regions only add levels.
    Without any place the added columns are NULL.
    """
    spots = queries.select(*axes).dropna().distinct().limit(FEW + 1).collect()
    if len(spots) <= FEW:
        winners = _few(spots, places, axes, key, squared)
        if carry:
            named = places.where(F.col(key).isin([r[key] for r in winners.select(key).dropna().distinct().collect()]))
            winners = winners.join(F.broadcast(named.select(key, *carry)), key, "left")  # a row per point
        return queries.join(F.broadcast(winners), axes, "left")
    grid = _Grid(places.dropna(subset=axes).groupBy(*axes).agg(F.min(key).alias(key)), axes)
    if grid.empty:
        schema = {f.name: f.dataType for f in places.schema}
        return queries.select(
            "*", *[F.lit(None).cast(schema[c]).alias(c) for c in (key, *carry)], F.lit(None).cast("double").alias(squared)
        )

    points = grid.at_top(queries.select(*axes).dropna().distinct())
    for table in grid.levels:
        points = grid.down(cells := grid.guess(points, table))
    reached = grid.candidates(cells, key).groupBy(*axes).agg(F.min("squared").alias("reach"))

    points = grid.at_top(materialize(reached, "reach"))
    for table in grid.levels:
        points = grid.down(cells := grid.within(points, table), "reach")
    winners = (
        grid.candidates(cells, key).where(F.col("squared") <= F.col("reach"))
        .groupBy(*axes).agg(F.min(F.struct("squared", key)).alias("best"))
        .select(*axes, f"best.{key}", F.col("best.squared").alias(squared))
    )
    winners = materialize(winners, "nearest")
    if carry:
        winners = materialize(lookup_join(winners, places.select(key, *carry), [key]), "nearest")
    return lookup_join(queries, winners, axes, "left")


def _few(spots: list, places: DataFrame, axes: list[str], key: str, squared: str) -> DataFrame:
    """The nearest place of each of a few points (axes, key, squared): a minimum per point over all places, of which
    every task sends one."""
    spark, types = places.sparkSession, places.schema
    nearest = [
        F.min(F.struct(_sum([(F.col(a) - float(s[a])) * (F.col(a) - float(s[a])) for a in axes]).alias("squared"), key)).alias(f"at{n}")
        for n, s in enumerate(spots)
    ]
    found = places.dropna(subset=axes).agg(*nearest).first() if spots else []
    rows = [(*[float(s[a]) for a in axes], *((b[key], b["squared"]) if b else (None, None))) for s, b in zip(spots, found)]
    fields = ", ".join(f"`{a}` double" for a in axes)
    return spark.createDataFrame(rows, f"{fields}, `{key}` {types[key].dataType.simpleString()}, `{squared}` double")


def on_sphere(df: DataFrame, latitude: str, longitude: str) -> DataFrame:
    """Add unit vectors: the nearest in straight-line distance is the nearest by great circle."""
    lat, lon = F.radians(latitude), F.radians(longitude)
    return df.withColumns({
        "_x": F.cos(lat) * F.cos(lon), "_y": F.cos(lat) * F.sin(lon), "_z": F.sin(lat),
    })


def nearest_place(
    queries: DataFrame, gazetteer: DataFrame, latitude: str, longitude: str, carry: list[str],
) -> DataFrame:
    """Add the columns ``place_id`` and ``carry`` of the gazetteer's (place_id, lat, lon, ...) nearest place
    on the globe."""
    axes = ["_x", "_y", "_z"]
    found = nearest_join(
        on_sphere(queries, latitude, longitude),
        on_sphere(gazetteer, "lat", "lon").select(*axes, "place_id", *carry),
        axes, "place_id", carry,
    )
    return found.drop(*axes, "squared_distance")
