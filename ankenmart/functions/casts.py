"""The casts of the staging layer."""

from __future__ import annotations

# SQL templates by cast name.
STAGING_CASTS = {
    # Half away from zero, where Spark's own cast would cut the fraction off.
    "int": "cast(round(cast({} AS double)) AS int)",
    "money": "cast({} AS decimal(18,2))",
}
