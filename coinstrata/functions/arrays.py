"""Array helpers that keep scans narrow and are safe on empty arrays under ANSI mode."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def zip_fields(array_column: str, *fields: str) -> Column:
    """Array of structs with only ``fields``.

    Exploding the whole struct array makes the scan read every nested field, scripts
    included. Picking the fields first lets nested column pruning reach the file scan.
    A null array stays null and a null element gives a struct of nulls.
    """
    return F.arrays_zip(*[F.col(f"{array_column}.{field}") for field in fields])


def first_of(array: Column) -> Column:
    """First element, or null for a null or empty array."""
    return F.get(array, F.lit(0))


def preferred_address(source_addresses: Column, raw_addresses: Column) -> Column:
    """First address of the spent output if it lists any, else of the input itself."""
    return F.when(F.size(source_addresses) > 0, first_of(source_addresses)).otherwise(
        first_of(raw_addresses)
    )
