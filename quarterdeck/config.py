"""Settings of a panel job. Every function takes them as arguments; nothing reads them as globals."""

from __future__ import annotations

from dataclasses import dataclass

# Statement sheets, their titles in the workbooks, and their print order.
SHEET_TITLES = {
    "BS": "Cân đối kế toán",
    "IS": "Báo cáo thu nhập",
    "CF": "Lưu chuyển tiền tệ",
    "NOTES": "Thuyết minh",
}

# Cleaned names of the label and unit columns of a statement sheet.
LABEL_COLUMN = "chi_tieu"
UNIT_COLUMN = "don_vi"

# 0-based rows of the export-date text and of the column headers within a sheet's used range.
EXPORT_DATE_ROW = 1
HEADER_ROW = 8

# Banks of the three peer groups.
STATE_BANKS = ("AGRB", "BID", "CTG", "VCB")
LARGE_PRIVATE_BANKS = ("VPB", "SHB", "VIB", "MBB", "ACB", "HDB", "TCB")
ALL_BANKS = (
    "AGRB", "BID", "CTG", "VPB", "VCB", "SHB", "STB", "VIB", "LPB", "MBB", "ACB", "HDB", "EIB", "SSB",
    "MSB", "ABB", "TPB", "OCB", "NAB", "BVB", "TCB", "VAB", "VBB", "PGB", "BAB", "NVB", "KLB", "SGB",
)


@dataclass(frozen=True)
class ItemRules:
    """How each line item behaves over time."""

    stock_marker: str = "BS"
    opening_items: tuple[str, ...] = ("CF_47",)
    closing_items: tuple[str, ...] = ("CF_48",)
    stock_notes: tuple[str, ...] = tuple(f"NOTES_{i}" for i in range(1, 120))
    ttm_prefix: str = "IS_"
    semi_annual: tuple = ()


@dataclass(frozen=True)
class PeerGroup:
    """A peer group. Labels are printf patterns that take the number of members present; None skips that row."""

    key: str
    mean_label: str | None = None
    total_label: str | None = None


# Labels of the group rows.
BANK_GROUPS = (
    PeerGroup("state", "BQ %d NHTM nhà nước"),
    PeerGroup("large", "BQ %d NHTM lớn"),
    PeerGroup("all", "BQ %d NHTM", "Tổng %d NHTM"),
)


@dataclass(frozen=True)
class Formula:
    """A metric: its name, its SQL expression over panel columns, and the output sheet."""

    metric: str
    text: str
    sheet: str = ""
