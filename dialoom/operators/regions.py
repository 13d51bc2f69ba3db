"""Regions of interest in frames, and the profiles by which images are prepared."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Profile:
    """How an image is prepared; steps at their neutral value are skipped."""

    name: str
    upscale_factor: float = 1.5
    sharpen: bool = False
    denoise: bool = False
    binarize: bool = False
    binarize_threshold: int = 128
    contrast_enhance: float = 1.0
    invert: bool = False


#: The profiles that are always there.
PROFILES = (
    Profile("default"),
    Profile("semi_transparent", upscale_factor=2.0, contrast_enhance=1.8, sharpen=True, binarize=True, binarize_threshold=100),
    Profile("outline_heavy", upscale_factor=2.0, sharpen=True, contrast_enhance=1.5),
    Profile("small_font", upscale_factor=3.0, sharpen=True, denoise=True),
    Profile("dark_bg", upscale_factor=1.5, contrast_enhance=1.3, invert=True, binarize=True),
)
PROFILE_SCHEMA = ("name string, upscale_factor double, sharpen boolean, denoise boolean, binarize boolean, binarize_threshold int, "
                  "contrast_enhance double, invert boolean")


def builtin_profiles(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([tuple(asdict(p).values()) for p in PROFILES], PROFILE_SCHEMA)


def override_profiles(own: DataFrame) -> DataFrame:
    """The built-in profiles and those of `own`, which replace them as whole records; fields left out take the defaults."""
    base = builtin_profiles(own.sparkSession)
    neutral = asdict(PROFILES[0])
    fields = base.columns[1:]
    given = own.select("name", *[(F.coalesce(F.col(c), F.lit(neutral[c])) if c in own.columns else F.lit(neutral[c])).cast(base.schema[c].dataType).alias(c) for c in fields])
    return base.join(given.select("name"), "name", "left_anti").unionByName(given)


def steps(profile: DataFrame) -> DataFrame:
    """(name, step): the steps of each profile in order, neutral ones skipped."""
    step = F.array_compact(F.array(
        F.when(F.col("upscale_factor") != 1.0, "upscale"), F.when(F.col("contrast_enhance") != 1.0, "contrast"), F.when(F.col("sharpen"), "sharpen"),
        F.when(F.col("denoise"), "denoise"), F.when(F.col("binarize"), "binarize"), F.when(F.col("invert"), "invert")))
    return profile.select("name", F.posexplode(step).alias("position", "step"))


def crop_box(roi: Column, width: Column, height: Column) -> Column:
    """struct(left, top, right, bottom) in pixels of a normalised region; all edges are truncated."""
    x, y, w, h = roi["x"], roi["y"], roi["w"], roi["h"]
    return F.struct((x * width).cast("int").alias("left"), (y * height).cast("int").alias("top"),
                    ((x + w) * width).cast("int").alias("right"), ((y + h) * height).cast("int").alias("bottom"))


def region_error(roi: Column) -> Column:
    """The first thing that is wrong with a normalised region, else null."""
    parts = [roi[c] for c in ("x", "y", "w", "h")]
    missing = parts[0].isNull() | parts[1].isNull() | parts[2].isNull() | parts[3].isNull()
    outside = ~(parts[0].between(0, 1) & parts[1].between(0, 1) & parts[2].between(0, 1) & parts[3].between(0, 1))
    return (F.when(roi.isNull() | missing, "missing").when(outside, "range").when((parts[2] <= 0) | (parts[3] <= 0), "area")
            .when((parts[0] + parts[2] > 1) | (parts[1] + parts[3] > 1), "overflow"))


def pixel_errors(box: Column, width: Column, height: Column) -> Column:
    """All errors of a pixel region struct(x, y, width, height) as an array of words."""
    x, y, w, h = box["x"], box["y"], box["width"], box["height"]
    return F.array_compact(F.array(
        F.when(x < 0, "x"), F.when(y < 0, "y"), F.when(w <= 0, "width"), F.when(h <= 0, "height"), F.when(x + w > width, "right"), F.when(y + h > height, "bottom")))


def rescale(box: Column, from_size: tuple[Column, Column], to_size: tuple[Column, Column]) -> Column:
    """A pixel region for another resolution; every value is truncated."""
    sx, sy = to_size[0] / from_size[0], to_size[1] / from_size[1]
    return F.struct((box["x"] * sx).cast("int").alias("x"), (box["y"] * sy).cast("int").alias("y"),
                    (box["width"] * sx).cast("int").alias("width"), (box["height"] * sy).cast("int").alias("height"))


def fits_frame(box: Column, width: Column, height: Column, least_width: int, least_height: int) -> Column:
    """A crop box lies in the frame and has the least size."""
    return ((box["left"] >= 0) & (box["top"] >= 0) & (box["right"] <= width) & (box["bottom"] <= height)
            & (box["right"] - box["left"] >= least_width) & (box["bottom"] - box["top"] >= least_height))
