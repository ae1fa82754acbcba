"""Target paths, completion markers and trigger files."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tablehaul.names import clean_table_path, table_stem
from tablehaul.operators.lines import trigger_text
from tablehaul.sources.files import write_small_text


def target_uri(
    root: str,
    table: str,
    env: str | None = None,
    delta_date: str | None = None,
    name_prefix: str = "",
    name_stamp: str = "",
) -> str:
    """``root/table``; with ``env`` ``root/env/full-data/table``, or
    ``root/env/delta-data/date/table`` for a delta load.

    ``name_prefix`` goes before the last part of the table's path and ``name_stamp``, with an
    underscore, behind it: Spark names the files, so the directory carries them.
    """
    parts = [root.rstrip("/")]
    if env:
        parts += [env, "delta-data", delta_date] if delta_date else [env, "full-data"]
    elif delta_date:
        raise ValueError("a delta target needs an environment name")
    folder, sep, name = clean_table_path(table).rpartition("/")
    stamped = f"{name_prefix}{name}" + (f"_{name_stamp}" if name_stamp else "")
    return "/".join([*parts, f"{folder}{sep}{stamped}"])


def marker_uri(uri: str, table: str) -> str:
    """The underscore hides the marker from readers, and an overwrite removes it."""
    return f"{uri.rstrip('/')}/_{table_stem(table)}_completed"


def write_marker(spark: SparkSession, uri: str, table: str) -> str:
    """Write the empty file that says the table in ``uri`` is whole."""
    marker = marker_uri(uri, table)
    write_small_text(spark, marker, "")
    return marker


def trigger_uri(uri: str, table: str, stamp: str) -> str:
    """Beside the table's directory, where no reader of the table meets it."""
    parent = uri.rstrip("/").rpartition("/")[0]
    return f"{parent}/{table_stem(table).upper()}_TRIGGER_{stamp}.TXT"


def write_trigger(
    spark: SparkSession, uri: str, table: str, stamp: str, rows: int, prefix: str | None = None
) -> str:
    """Write the trigger row of a pipe export."""
    path = trigger_uri(uri, table, stamp)
    write_small_text(spark, path, trigger_text(table, stamp, rows, prefix) + "\n")
    return path


def s3a_settings(endpoint: str | None = None, region: str | None = None) -> dict[str, str]:
    """Hadoop settings for ``s3a://`` targets: server-side AES256, and for an own endpoint
    plain HTTP with path-style access. Credentials come from the cluster's provider."""
    settings = {"fs.s3a.encryption.algorithm": "AES256"}
    if region:
        settings["fs.s3a.endpoint.region"] = region
    if endpoint:
        settings["fs.s3a.endpoint"] = endpoint
        settings["fs.s3a.path.style.access"] = "true"
        settings["fs.s3a.connection.ssl.enabled"] = "false"
    return settings
