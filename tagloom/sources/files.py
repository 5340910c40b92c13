"""File listings and JSON settings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CONTRACT_SCHEMA = """
    family string,
    supported_workbook_family struct<
        workbook_xml_sha256: string, workbook_xml_sha256_allowlist: array<string>, file_sha256: string>,
    preserved_topology struct<
        sheet_count: int, sheet_order: array<string>, sheet_states: map<string, string>,
        sheet_states_variants: array<map<string, string>>>,
    writable_surface struct<
        primary_target: struct<sheet_name: string, allowed_ranges: array<string>>,
        linked_card_rules: struct<
            card_anchor_row: int, header_row: int, link_row: int, write_row: int,
            link_column_offset_from_anchor: int, write_column_offset_from_anchor: int,
            card_anchor_label: string, header_label: string>,
        linked_card_targets: string, linked_card_targets_variants: string>
"""

ALLOWLIST_SCHEMA = """
    allowed_changed_parts array<string>, allowed_changed_part_prefixes array<string>,
    allowed_changed_part_patterns array<string>, allowed_changed_sheet_names array<string>,
    include_contract_writable_surface_sheet_xml boolean, contract_path string
"""


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """``(path, folder, modified, length)`` of all files under ``root``; no content is read."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true").load(root)
        .select(
            "path", F.regexp_replace("path", "/[^/]*$", "").alias("folder"),
            F.col("modificationTime").alias("modified"), "length",
        )
    )


def single_inputs(files: DataFrame) -> DataFrame:
    """The file of each folder that holds exactly one: ``(folder, path)``."""
    return (
        files.groupBy("folder").agg(F.count("*").alias("n"), F.min("path").alias("path"))
        .filter("n = 1").select("folder", "path")
    )


def newest(files: DataFrame, group: str = "folder") -> DataFrame:
    """The newest file of each group; of equally new ones the last by path."""
    return files.groupBy(group).agg(F.max(F.struct("modified", "path")).alias("m")).select(
        group, "m.path", "m.modified"
    )


def read_contracts(spark: SparkSession, path: str) -> DataFrame:
    """Contracts as written; a file without a family counts as the family ``default``.

    Card targets stay JSON text, so a malformed entry does not spoil the others.
    """
    raw = spark.read.schema(CONTRACT_SCHEMA).json(path, multiLine=True)
    return raw.withColumn("family", F.coalesce("family", F.lit("default")))


def read_allowlist(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ALLOWLIST_SCHEMA).json(path, multiLine=True)
