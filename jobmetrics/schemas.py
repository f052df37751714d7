"""Declared table layouts, as Spark DDL strings.

Fixed values: names and types follow the source system's tables. ``float`` columns are
DOUBLE here, ``tinyint(1)`` is BOOLEAN, JSON documents stay STRING.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# The raw event table: one wide row per tracked action, keyed by create_time.
TRACKING = """
    create_time STRING NOT NULL, bid DOUBLE, bn STRING, campaign_id DOUBLE, cd DOUBLE,
    custom_track STRING, de STRING, dl STRING, dt STRING, ed STRING, ev DOUBLE,
    group_id DOUBLE, id DOUBLE, job_id DOUBLE, md STRING, publisher_id DOUBLE, rl STRING,
    sr STRING, ts STRING, tz DOUBLE, ua STRING, uid STRING, utm_campaign DOUBLE,
    utm_content DOUBLE, utm_medium DOUBLE, utm_source STRING, utm_term DOUBLE, v DOUBLE,
    vp STRING
"""

# The message on the event topic and the column list of its CSV export.
MESSAGE = """
    create_time STRING, bid DOUBLE, campaign_id DOUBLE, custom_track STRING,
    group_id DOUBLE, job_id DOUBLE, publisher_id DOUBLE, ts STRING
"""

MESSAGE_FIELDS = ["create_time", "bid", "campaign_id", "custom_track", "group_id", "job_id",
                  "publisher_id", "ts"]
MESSAGE_NUMBERS = ["bid", "campaign_id", "group_id", "job_id", "publisher_id"]

# The hourly fact. Counts are BIGINT so that a cell cannot overflow, ids so that none is cut.
FACT = """
    id BIGINT, job_id BIGINT, dates DATE, hours INT, publisher_id BIGINT, company_id BIGINT,
    campaign_id BIGINT, group_id BIGINT, disqualified_application BIGINT,
    qualified_application BIGINT, conversion BIGINT, clicks BIGINT, bid_set DOUBLE,
    spend_hour DOUBLE, sources STRING, updated_at TIMESTAMP
"""

CAMPAIGN = """
    id INT NOT NULL, created_by STRING, created_date TIMESTAMP, last_modified_by STRING,
    last_modified_date TIMESTAMP, is_active BOOLEAN, campaign_name STRING,
    budget_total DOUBLE, unit_budget STRING, start_date TIMESTAMP, end_date TIMESTAMP,
    close_date TIMESTAMP, campaign_status INT, background_status INT, pacing_unit STRING,
    company_id INT, number_of_pacing INT, recommend_budget DOUBLE, import_xml_url STRING,
    bid_set DOUBLE, ats_type STRING, ats_data STRING
"""

COMPANY = """
    id INT NOT NULL, created_by STRING, created_date TIMESTAMP, last_modified_by STRING,
    last_modified_date TIMESTAMP, is_active BOOLEAN, name STRING,
    is_agree_conditon BOOLEAN, is_agree_sign_deal BOOLEAN, sign_deal_user STRING,
    billing_id INT, manage_type INT, customer_type INT, status INT, publisher_id INT,
    flat_rate DOUBLE, percentage_of_click DOUBLE, logo STRING
"""

JOB_GROUP = """
    id INT NOT NULL, created_by STRING, created_date TIMESTAMP, last_modified_by STRING,
    last_modified_date TIMESTAMP, is_active BOOLEAN, name STRING, budget_group INT,
    status INT, company_id INT, campaign_id INT, number_of_pacing INT
"""

JOB = """
    id INT NOT NULL, created_by STRING, created_date TIMESTAMP, last_modified_by STRING,
    last_modified_date TIMESTAMP, is_active BOOLEAN, title STRING, description STRING,
    work_schedule STRING, radius_unit STRING, location_state STRING, location_list STRING,
    role_location STRING, resume_option STRING, budget DOUBLE, status INT, error STRING,
    template_question_id INT, template_question_name STRING,
    question_form_description STRING, redirect_url STRING, start_date DATE, end_date DATE,
    close_date DATE, group_id INT, minor_id INT, campaign_id INT, company_id INT,
    history_status INT, ref_id INT
"""

PUBLISHER = """
    id INT NOT NULL, created_by STRING, created_date TIMESTAMP, last_modified_by STRING,
    last_modified_date TIMESTAMP, is_active BOOLEAN, publisher_name STRING, email STRING,
    access_token STRING, publisher_type BOOLEAN, publisher_status BOOLEAN,
    publisher_frequency INT, currency STRING, time_zone STRING, cpc_increment INT,
    bid_reading BOOLEAN, min_bid DOUBLE, max_bid DOUBLE, countries STRING,
    data_sharing STRING
"""

TRACKING_SUMMARY = "create_time STRING, bid DOUBLE, bn STRING, campaign_id INT, cd INT"

# Table name -> (layout, partition columns). `group` is a reserved word, hence job_group.
TABLES = {
    "tracking": (TRACKING, []),
    "events": (FACT, ["dates"]),
    "campaign": (CAMPAIGN, []),
    "company": (COMPANY, []),
    "job_group": (JOB_GROUP, []),
    "job": (JOB, []),
    "publisher": (PUBLISHER, []),
    "tracking_summary": (TRACKING_SUMMARY, []),
}


def struct(spark: SparkSession, ddl: str) -> StructType:
    return spark.createDataFrame([], ddl).schema


def column_names(ddl: str) -> list[str]:
    return [part.split()[0] for part in ddl.split(",")]


def schema_check(df: DataFrame, ddl: str) -> list[str]:
    """Differences between a table and its declared layout, empty when they agree.

    Nullability is not compared: file sources report every column as nullable.
    """
    declared = {f.name: f.dataType.simpleString() for f in struct(df.sparkSession, ddl)}
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    problems = [f"missing column {name}" for name in declared if name not in actual]
    problems += [f"unexpected column {name}" for name in actual if name not in declared]
    problems += [
        f"column {name} is {actual[name]}, declared {kind}"
        for name, kind in declared.items()
        if name in actual and actual[name] != kind
    ]
    return problems
