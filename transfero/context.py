"""Scalar context of a migration run: company, fiscal year and fixed defaults."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class MigrationContext:
    company: int = 1          # target company id (cadcli.empresa)
    fiscal_year: int = 1998   # exercise being migrated
    order_id_start: int = 0   # first purchase-order id minus one (no existing orders by default)
    fleet_year: int = 2024    # exercise of the fleet module (fuel movements are loaded for this year)

    @property
    def yy(self) -> str:
        """Two-digit year as printed in document numbers (`nnnnn/yy`)."""
        return str(self.fiscal_year)[2:4]

    @property
    def fleet_yy(self) -> str:
        return str(self.fleet_year)[2:4]


DEFAULT_CONTEXT = MigrationContext()
