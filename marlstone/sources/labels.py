"""Label files: text lines to rows. Lenient, strict and library readers differ on purpose."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.functions.geometry import polygon_area


def read_lines(spark: SparkSession, glob: str) -> DataFrame:
    """image_id (file stem), line_no, line of every label file under a glob."""
    lines = spark.read.text(glob, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.[^./]*$", 1).alias("image_id"), F.posexplode(F.split("value", "\r?\n")).alias("line_no", "line"))
    return lines.where(F.trim("line") != "")


def _tokens(line: Column) -> Column:
    return F.split(F.trim(line), r"\s+")


def parse_boxes(lines: DataFrame) -> DataFrame:
    """Adds class_id, cx, cy, w, h, valid (five numbers) and anomaly (values or corners outside [0, 1], or no size)."""
    d = lines.withColumn("t", _tokens(F.col("line"))).withColumn("v", F.transform("t", lambda x: x.try_cast("double")))
    ok = (F.size("t") == 5) & ~F.exists("v", lambda x: x.isNull())
    cx, cy, w, h = (F.get("v", F.lit(i)) for i in range(1, 5))
    out = d.withColumn("valid", ok).withColumns({"class_id": F.when(ok, F.get("v", F.lit(0)).cast("int")), "cx": F.when(ok, cx), "cy": F.when(ok, cy), "w": F.when(ok, w), "h": F.when(ok, h)})
    outside = (F.col("w") <= 0) | (F.col("h") <= 0) | (F.col("cx") - F.col("w") / 2 < 0) | (F.col("cy") - F.col("h") / 2 < 0) | (F.col("cx") + F.col("w") / 2 > 1) | (F.col("cy") + F.col("h") / 2 > 1)
    return out.withColumn("anomaly", ok & outside).drop("t", "v")


def parse_boxes_strict(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that are right in every respect, the others with a reason)."""
    p = parse_boxes(lines)
    whole = F.get(_tokens(F.col("line")), F.lit(0)).rlike(r"^\d+$")
    reason = F.when(~F.col("valid"), "not five numbers").when(~whole, "class is no whole number").when(F.col("anomaly"), "outside the image")
    p = p.withColumn("reason", reason)
    return p.where("reason is null").drop("reason"), p.where("reason is not null").select("image_id", "line_no", "line", "reason")


def parse_boxes_library(lines: DataFrame) -> DataFrame:
    """Valid rows; lines that repeat within a file count once, at their first place."""
    return parse_boxes(lines.groupBy("image_id", "line").agg(F.min("line_no").alias("line_no"))).where("valid")


def parse_polygons(lines: DataFrame) -> DataFrame:
    """class_id, coords, area of rows with an odd count of at least seven numbers."""
    d = lines.withColumn("v", F.transform(_tokens(F.col("line")), lambda x: x.try_cast("double")))
    d = d.where((F.size("v") >= 7) & (F.size("v") % 2 == 1) & ~F.exists("v", lambda x: x.isNull()))
    coords = F.slice("v", 2, F.size("v") - 1)
    return d.select("image_id", "line_no", F.get("v", F.lit(0)).cast("int").alias("class_id"), coords.alias("coords"), polygon_area(coords).alias("area"))


def read_coco(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(images, annotations, categories) of COCO JSON files."""
    d = spark.read.schema(
        "images array<struct<id:long,file_name:string,width:int,height:int>>, annotations array<struct<id:long,image_id:long,category_id:int,bbox:array<double>,area:double,iscrowd:int>>, categories array<struct<id:int,name:string>>"
    ).json(path, multiLine=True)
    return tuple(d.select(F.explode(c).alias("r")).select("r.*") for c in ("images", "annotations", "categories"))


def image_folder(paths: DataFrame, path: str = "path") -> DataFrame:
    """split and class of .../<split>/<class>/<file>."""
    p = F.split(path, "/")
    return paths.select(path, F.element_at(p, -3).alias("split"), F.element_at(p, -2).alias("class"))


def label_path(path: Column) -> Column:
    """The last path component images or image becomes labels, and the suffix .txt."""
    return F.regexp_replace(F.regexp_replace(path, r"(?i)^(.*/)images?(/(?:(?!/images?/).)*)$", "$1labels$2"), r"\.[^./]*$", ".txt")


def write_boxes(boxes: DataFrame, path: str) -> None:
    """One text file of label lines per image, under image_id=.../."""
    line = F.format_string("%d %.6f %.6f %.6f %.6f", "class_id", "cx", "cy", "w", "h")
    boxes.orderBy("image_id", "line_no").select("image_id", line.alias("value")).write.partitionBy("image_id").text(path)


def write_csv(df: DataFrame, columns: list[str], path: str) -> None:
    """Only the named columns; those that are missing come out empty."""
    df.select(*[F.col(c) if c in df.columns else F.lit("").alias(c) for c in columns]).write.csv(path, header=True)
