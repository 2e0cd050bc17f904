"""Column layouts of the tables this package reads and writes."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType


def _strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


# --- Fixed values: column names of the posting messages and of the stored tables
POSTING = _strings(
    "id", "name", "chuyen_mon", "mo_ta_cong_viec", "yeu_cau_cong_viec", "quyen_loi",
    "dia_diem_lam_viec", "thoi_gian_lam_viec", "cach_thuc_ung_tuyen",
)
POSTING_BATCH = _strings(
    "id", "name", "mo_ta_cong_viec", "yeu_cau_cong_viec", "quyen_loi",
    "dia_diem_lam_viec", "thoi_gian_lam_viec", "cach_thuc_ung_tuyen",
)
POSTING_STREAM = _strings(
    "id", "name", "chuyen_mon", "mo_ta_cong_viec", "yeu_cau_cong_viec", "quyen_loi",
    "cach_thuc_ung_tuyen",
)
POSTING_RAW_STORE = _strings(
    "id", "name", "mo_ta_cong_viec", "yeu_cau_cong_viec", "quyen_loi", "cach_thuc_ung_tuyen",
)
EXTRACTED = StructType(
    [
        StructField("id", StringType()),
        StructField("company_name", StringType()),
        StructField("framework_platforms", ArrayType(StringType())),
        StructField("languages", ArrayType(StringType())),
        StructField("design_patterns", ArrayType(StringType())),
        StructField("knowledges", ArrayType(StringType())),
        StructField("salaries", ArrayType(IntegerType())),
    ]
)
# Names the same columns carry in the batch document index.
INDEX_NAMES = {
    "company_name": "CompanyName",
    "framework_platforms": "FrameworkPlattforms",
    "languages": "Languages",
    "design_patterns": "DesignPatterns",
    "knowledges": "Knowledges",
    "salaries": "Salaries",
}
# --- End of fixed values
