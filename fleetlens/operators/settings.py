"""Layered settings and what is filled from them."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Layers, lowest first.
DEFAULTS, MAIN_FILE, DROP_IN, COMMAND_LINE = 0, 1, 2, 3
# What files set for all sections: the lowest of the file layers, whatever its number.
FILE_DEFAULTS = -1

# Old key -> new key, for settings that come from files.
RENAMED_KEYS = {"rhevm": "engine", "engine-ca": "cert-file"}

_PLACEHOLDER = re.compile(r"%%|%\(([^)]*)\)s")


def effective_settings(
    settings: DataFrame,
    renamed: Mapping[str, str] = RENAMED_KEYS,
    file_layers: Iterable[int] = (FILE_DEFAULTS, MAIN_FILE, DROP_IN),
) -> DataFrame:
    """The value each run ends up with: (run_id, key, value).

    Input is (run_id, layer, file, seq, key, value). The last value by layer,
    file and seq wins; null never overrides. Inside the file layers an old key
    counts as its new one, but only where no file sets the new key. The file
    layers as a whole rank where the highest of them does.
    """
    file_layers = sorted(file_layers)
    key, layer = F.col("key"), F.col("layer")
    in_files = layer.isin(file_layers)
    old = in_files & key.isin(list(renamed))
    new_key = key
    for old_name, new_name in renamed.items():
        new_key = F.when(old & (key == old_name), new_name).otherwise(new_key)
    # All file layers rank as one, so that an old key loses to the new key of any file.
    rank = F.when(in_files, file_layers[-1]).otherwise(layer) if file_layers else layer
    order = F.struct(rank, ~old, layer, F.coalesce("file", F.lit("")), "seq")
    return (
        settings.filter(F.col("value").isNotNull())
        .select("run_id", new_key.alias("key"), "value", order.alias("_order"))
        .groupBy("run_id", "key")
        .agg(F.max_by("value", "_order").alias("value"))
    )


def with_defaults(settings: DataFrame, defaults: Mapping[str, str], keys: DataFrame) -> DataFrame:
    """A value for every (run_id, key) asked for: set, else the default, else null."""
    default = F.lit(None).cast("string")
    for key, value in defaults.items():
        default = F.when(F.col("key") == key, value).otherwise(default)
    return keys.join(settings, ["run_id", "key"], "left").select(
        "run_id", "key", F.coalesce("value", default).alias("value")
    )


def settings_check(settings: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Per run whether all, and whether any, of the keys hold a non-empty value."""
    keys = list(dict.fromkeys(keys))
    is_set = F.coalesce(F.col("value") != "", F.lit(False))
    flags = [F.coalesce(F.bool_or(F.when(F.col("key") == key, is_set)), F.lit(False)) for key in keys]
    return (
        settings.groupBy("run_id")
        .agg(F.array(*flags).alias("_set"))
        .select(
            "run_id",
            F.forall("_set", lambda flag: flag).alias("has_all"),
            F.exists("_set", lambda flag: flag).alias("has_any"),
        )
    )


def placeholders(template: str) -> list[str]:
    """The setting keys a template names, each once."""
    return list(dict.fromkeys(key for key in _PLACEHOLDER.findall(template) if key))


def render_template(settings: DataFrame, template: str, output: str = "rendered") -> DataFrame:
    """``%(key)s`` filled from the settings of each run; ``%%`` is a percent sign.

    The result is null for a run that lacks one of the keys. Only the keys the
    template names are read, so no run's whole settings meet in one row.
    """
    keys = placeholders(template)
    names = {key: f"_{index}" for index, key in enumerate(keys)}
    parts, at = [], 0
    for found in _PLACEHOLDER.finditer(template):
        parts.append(F.lit(template[at : found.start()]))
        parts.append(F.col(names[found.group(1)]) if found.group(1) else F.lit("%"))
        at = found.end()
    parts.append(F.lit(template[at:]))
    if not keys:
        return settings.select("run_id").distinct().select("run_id", F.concat(*parts).alias(output))
    # Runs without any of the keys stay in with a null result.
    wanted = F.when(F.col("key").isin(keys), F.col("value"))
    return (
        settings.groupBy("run_id")
        .agg(*[F.max(F.when(F.col("key") == key, wanted)).alias(name) for key, name in names.items()])
        .select("run_id", F.concat(*parts).alias(output))
    )


def fill(template: Column, settings: Column) -> Column:
    """``%(key)s`` in a template column filled from a map column, in one pass.

    Filled-in values are not searched again. A missing key gives null.
    """
    token = r"%%|%\([^)]*\)s"
    literals = F.split(template, token)
    tokens = F.regexp_extract_all(template, F.lit(f"({token})"), 0)
    # concat passes a null on, array_join would drop it.
    return F.aggregate(
        F.arrays_zip(literals.alias("text"), tokens.alias("token")),
        F.lit(""),
        lambda out, part: F.concat(
            out,
            part["text"],
            F.when(part["token"].isNull(), "")
            .when(part["token"] == "%%", "%")
            .otherwise(F.element_at(settings, F.regexp_replace(part["token"], r"\A%\(|\)s\z", ""))),
        ),
    )
