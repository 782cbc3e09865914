"""Class colours: a text file with one ``[r, g, b]`` line per class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The colours of the two supported label sets, in class order.
PETS = [(0, 10, 146), (38, 0, 44), (255, 232, 0)]
SIDEWALKS = [
    (0, 0, 0), (216, 82, 24), (255, 255, 0), (125, 46, 141), (118, 171, 47), (161, 19, 46), (255, 0, 0),
    (0, 128, 128), (190, 190, 0), (0, 255, 0), (0, 0, 255), (170, 0, 255), (84, 84, 0), (84, 170, 0),
    (84, 255, 0), (170, 84, 0), (170, 170, 0), (170, 255, 0), (255, 84, 0), (255, 170, 0), (255, 255, 0),
    (33, 138, 200), (0, 170, 127), (0, 255, 127), (84, 0, 127), (84, 84, 127), (84, 170, 127), (84, 255, 127),
    (170, 0, 127), (170, 84, 127), (170, 170, 127), (170, 255, 127), (255, 0, 127), (255, 84, 127),
    (255, 170, 127),
]
MAX_CLASSES = 65_536  # of a palette; more are refused


def parse_colour(line: Column) -> Column:
    """``[0, 10, 146]`` as an int array."""
    return F.transform(F.split(F.btrim(line, F.lit("[]")), ", "), lambda x: x.cast("int"))


def parse_palette(files: DataFrame, text: str = "value") -> DataFrame:
    """Palette rows from whole file texts. A line with ``#`` anywhere is a comment.

    Classes count the remaining lines in file order; the last line may lack its line end. The lines of a text are
    numbered where they are split, so no window gathers them; there should be one text.
    """
    kept = F.filter(F.split(F.col(text), "\n"), lambda line: ~F.contains(line, F.lit("#")) & (line != ""))
    lines = files.select(F.posexplode(kept).alias("class", "_line")).select("class", parse_colour(F.col("_line")).alias("_rgb"))
    return lines.select("class", *[F.col("_rgb")[i].alias(n) for i, n in enumerate("rgb")])


def read_palette(spark: SparkSession, path: str) -> DataFrame:
    return parse_palette(spark.read.text(path, wholetext=True))


def palette_table(spark: SparkSession, colours: list[tuple[int, int, int]]) -> DataFrame:
    rows = [(i, *rgb) for i, rgb in enumerate(colours)]
    return spark.createDataFrame(rows, "class int, r int, g int, b int")


def colours_of(palette: DataFrame) -> list[tuple[int, int, int]]:
    """The palette as a list; refused beyond 65,536 classes."""
    rows = palette.orderBy("class").take(MAX_CLASSES + 1)
    if len(rows) > MAX_CLASSES:
        raise ValueError("palette is too large")
    if [r["class"] for r in rows] != list(range(len(rows))):
        raise ValueError("palette classes must count up from 0")
    return [(r["r"], r["g"], r["b"]) for r in rows]
