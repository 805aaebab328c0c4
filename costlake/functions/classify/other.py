"""Inline rule sets of the 'other' models. Patterns and labels."""

from __future__ import annotations

from costlake.functions.classify import like_rules

UT = "usage_type"

API_GATEWAY_USAGE = [
    (("or", ("like", UT, "%ApiGatewayRequest%"), ("like", UT, "%ApiGatewayHttpRequest%")), "Requests"),
    (("like", UT, "%DataTransfer%"), "Data Transfer"),
    (("like", UT, "%Message%"), "Messages"),
    (("like", UT, "%Minute%"), "Minutes"),
    (("like", UT, "%CacheUsage%"), "Cache Usage"),
]
API_GATEWAY_USAGE_DEFAULT = "Other"

CONFIG_USAGE = like_rules(UT, [
    ("%ConfigurationItemRecorded", "Config Items Recorded"),
    ("%ConfigurationItemRecordedDaily", "Config Items Recorded Daily"),
    ("%ConfigRuleEvaluations", "Config Rule Evaluations"),
    ("%ConformancePackEvaluations", "Conformance Pack Evaluations"),
])
CONFIG_USAGE_DEFAULT = "Others"

RDS_EXTENDED_SUPPORT = like_rules(UT, [
    ("%Yr1-Yr2%", "RDS Extended Support Year 1-2"),
    ("%Yr3%", "RDS Extended Support Year 3+"),
])
RDS_EXTENDED_SUPPORT_DEFAULT = "RDS Extended Support"

EXTENDED_SUPPORT_ENGINE = like_rules(UT, [
    ("%AuroraMySQL%", "Aurora MySQL"),
    ("%AuroraPostgreSQL%", "Aurora PostgreSQL"),
    ("%MySQL%", "MySQL"),
    ("%PostgreSQL%", "PostgreSQL"),
    ("%Oracle%", "Oracle"),
    ("%SQLServer%", "SQL Server"),
])
EXTENDED_SUPPORT_ENGINE_DEFAULT = "none"
ENGINE_VERSION_PATTERN = r"(MySQL|PostgreSQL|AuroraMySQL|AuroraPostgreSQL)(\d+(?:\.\d+)?)"
