"""Declared schemas. Every code is a string: leading zeros carry meaning."""

from pyspark.sql import types as T


_KINDS: dict[str, T.DataType] = {
    "string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(),
    "boolean": T.BooleanType(), "date": T.DateType(), "timestamp": T.TimestampType(),
    "decimal(8,5)": T.DecimalType(8, 5), "decimal(10,6)": T.DecimalType(10, 6), "decimal(18,2)": T.DecimalType(18, 2),
}


def _struct(spec: str) -> T.StructType:
    """Schema from ``name type [not null], ...``; unlike a DDL string it needs no running session."""
    fields = []
    for part in spec.split(", "):
        name, kind, *rest = part.split()
        fields.append(T.StructField(name, _KINDS[kind], nullable=not rest))
    return T.StructType(fields)


GROUND_TRUTH = _struct(
    "transaction_code string, gt_desc string, gt_L1 string, gt_L2 string, gt_L3 string, gt_L4 string, "
    "gt_credit_debit string"
)

COLUMN_MAPPINGS = _struct("client_column string, canonical_column string, run_timestamp timestamp")

TRANSACTION_CATALOG = _struct(
    "transaction_code string, description_samples string, volume bigint, source_file string, layer int"
)

CLASSIFICATION_RESULTS = _struct(
    "transaction_code string, description_samples string, volume bigint, source_file string, layer int, "
    "category_1 string, category_2 string, category_3 string, category_4 string, include_in_scoring boolean, "
    "credit_debit string, confidence double, prompt_version string, model_name string, run_timestamp timestamp, "
    "tokens_in bigint, tokens_out bigint, estimated_cost double, llm_raw string, batch_id string, "
    "was_requested boolean"
)

EVALUATION_RESULTS = _struct(
    "transaction_code string, layer int, prompt_version string, model_name string, description_samples string, "
    "volume bigint, source_file string, category_1 string, category_2 string, category_3 string, category_4 string, "
    "gt_L1 string, gt_L2 string, gt_L3 string, gt_L4 string, match_L1 boolean, match_L2 boolean, match_L3 boolean, "
    "match_L4 boolean, exact_match boolean, partial_match_L1L2 boolean, partial_match_L1L2L3 boolean, "
    "confidence double, failure_type string, review_status string"
)

PRODUCT_GROUND_TRUTH = _struct(
    "product_code string, product_name string, gt_L1_line_of_business string, gt_L2_type string, "
    "gt_L3_category string, gt_L4_subcategory string, gt_L5_special string, product_domain string"
)

PRODUCT_CATALOG = _struct(
    "product_code string, product_name string, account_count bigint, source_file string, "
    "purcod_distribution string, purpose_distribution string, sample_loan_type_desc string, layer int"
)

PRODUCT_CLASSIFICATION_RESULTS = _struct(
    "product_code string, product_name string, source_file string, account_count bigint, layer int, "
    "line_of_business string, product_type string, product_category string, product_subcategory string, "
    "product_special string, confidence double, reasoning string, prompt_version string, model_name string, "
    "run_timestamp timestamp, tokens_in bigint, tokens_out bigint, estimated_cost double, llm_raw string, "
    "batch_id string, was_requested boolean"
)

PRODUCT_EVALUATION_RESULTS = _struct(
    "product_code string, layer int, prompt_version string, model_name string, product_name string, "
    "account_count bigint, source_file string, line_of_business string, product_type string, "
    "product_category string, product_subcategory string, product_special string, gt_L1_line_of_business string, "
    "gt_L2_type string, gt_L3_category string, gt_L4_subcategory string, gt_L5_special string, match_L1 boolean, "
    "match_L2 boolean, match_L3 boolean, match_L4 boolean, match_L5 boolean, canonical_match boolean, "
    "full_match boolean, exact_match boolean, partial_match_L1L2 boolean, partial_match_L1L2L3 boolean, "
    "confidence double, failure_type string, review_status string"
)

ACCOUNT_HISTORY = _struct(
    "AccountIdentifier string not null, ProductInstanceReference string, ProductInstanceDescription string, "
    "BranchLocationReference string, AccountOpeningDate date, AccountClosingDate date, AccountStatus string, "
    "InterestRate decimal(8,5), MinimumBalance decimal(18,2), effective_ts timestamp, valid_from timestamp, "
    "valid_to timestamp"
)

PRODUCT_MASTER = _struct(
    "PROD_product_type_id string, PROD_core_system_mapping string, PROD_line_of_business string, "
    "PROD_product_category string, PROD_product_type string, PROD_product_name string, PROD_product_code string, "
    "PROD_status string, PROD_balance_requires_abs boolean, PROD_created_date timestamp, "
    "PROD_modified_date timestamp"
)

PRODUCT_SUGGESTIONS = _struct(
    "PROD_product_type_id string not null, PROD_line_of_business string, PROD_product_category string, "
    "PROD_product_type string, PROD_product_name string, PROD_product_code string, PROD_status string not null, "
    "PROD_core_system_mapping string not null, PROD_balance_requires_abs boolean not null, "
    "PROD_created_date timestamp not null, PROD_modified_date timestamp not null, "
    "processing_timestamp timestamp not null, review_status string not null, confidence decimal(10,6), "
    "ai_model string, prompt_version string, description_samples string, volume bigint"
)

NEW_CODE_REPORT = _struct("code string, first_seen timestamp, volume bigint")

TRANSACTION_RESPONSE = (
    "classifications array<struct<transaction_code:string,category_1:string,category_2:string,category_3:string,"
    "category_4:string,include_in_scoring:boolean,credit_debit:string,confidence:double>>"
)

PRODUCT_RESPONSE = (
    "classifications array<struct<product_code:string,line_of_business:string,product_type:string,"
    "product_category:string,product_subcategory:string,product_special:string,confidence:double,reasoning:string>>"
)

SUGGESTION_RESPONSE = (
    "classifications array<struct<PROD_core_system_mapping:string,PROD_line_of_business:string,"
    "PROD_product_category:string,PROD_product_type:string,PROD_product_name:string,PROD_product_code:string,"
    "confidence:double>>"
)
