"""Monthly trade feeds: exports and imports with their headers renamed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from stratamill.sources.files import load_labelled_feeds

# Workbook header to column name, and the labels of the two sheets.
HEADERS = {
    "Năm": "nam",
    "Tháng": "thang",
    "MST": "ma_so_thue",
    "Tên DN": "ten_dn",
    "Địa chỉ": "dia_chi",
    "Tỉnh": "tinh",
    "Điện thoại": "dien_thoai",
    "Mã nước": "ma_nuoc",
    "Tên nước": "ten_nuoc",
    " Kim ngạch": "kim_ngach",
    "Mặt hàng lớn nhất": "mat_hang_lon_nhat",
}
EXPORTS = "Xuat khau"
IMPORTS = "Nhap khau"


def trade_feeds(spark: SparkSession, paths: Mapping[str, str], as_of: str, file_format: str = "csv") -> DataFrame:
    """Exports and imports in one frame; ``paths`` maps each label to its file or folder."""
    rows = load_labelled_feeds(spark, paths, HEADERS, as_of, file_format)
    return rows.select(*HEADERS.values(), "cob_dt", "type")
