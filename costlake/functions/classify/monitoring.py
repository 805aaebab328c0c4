"""Monitoring rule sets. Fixed values: (usage type pattern, label), first match wins."""

from __future__ import annotations

from costlake.functions.classify import like_rules

CLOUDWATCH_PATTERNS = [
    ("%DataProcessing-Bytes%", "CloudWatch Logs [Ingest]"),
    ("%DataProcessingIA-Bytes%", "CloudWatch Logs [Ingest]"),
    ("%TimedStorage-ByteHrs%", "CloudWatch Logs [Storage]"),
    ("%VendedLog-Bytes-CFLogs%", "CloudWatch Vended Logs [Send to CW]"),
    ("%VendedLog-Bytes%", "CloudWatch Vended Logs [Send to CW]"),
    ("%VendedLogIA-Bytes%", "CloudWatch Vended Logs [Send to CW]"),
    ("%S3-Egress-Bytes%", "CloudWatch Vended Logs [Send to S3]"),
    ("%S3-Egress-InputBytes%", "CloudWatch Vended Logs [Send to S3]"),
    ("%FH-Egress-Bytes-CFLogs%", "CloudWatch Vended Logs [Send to Data Firehose]"),
    ("%FH-Egress-Bytes%", "CloudWatch Vended Logs [Send to Data Firehose]"),
    ("%DataScanned-Bytes%", "CloudWatch Logs [Insights Query]"),
    ("%Logs-LiveTail%", "CloudWatch Logs [Live Tail]"),
    ("%DataProtection-Bytes%", "CloudWatch Logs [Data Protection]"),
    ("%DashboardsUsageHour-Basic%", "CloudWatch Dashboards"),
    ("%DashboardsUsageHour%", "CloudWatch Dashboards"),
    ("%CW:Requests%", "CloudWatch API Requests"),
    ("%CW:GMD-Metrics%", "CloudWatch API Requests [GetMetricData]"),
    ("%CW:GMWI-Metrics%", "CloudWatch API Requests [GetMetricWidgetImage]"),
    ("%CW:GIRR-Metrics%", "CloudWatch API Requests [GetInsightRuleReport]"),
    ("%CW:AlarmMonitorUsage%", "CloudWatch Alarms [Standard]"),
    ("%CW:HighResAlarmMonitorUsage%", "CloudWatch Alarms [Standard]"),
    ("%CW:CompositeAlarmMonitorUsage%", "CloudWatch Alarms [Composite]"),
    ("%CW:MetricInsightAlarmUsage%", "CloudWatch Alarms [Metrics Insights]"),
    ("%CW:MetricsUsage%", "CloudWatch Metrics [Custom]"),
    ("%CW:MetricMonitorUsage%", "CloudWatch Metrics [Custom]"),
    ("%CW:ObservationUsage%", "CloudWatch Metrics [Observation]"),
    ("%CW:MetricStreamUsage%", "CloudWatch Metrics [Streams]"),
    ("%CW:Canary-runs%", "CloudWatch Synthetics"),
    ("%DatabaseInsights%", "CloudWatch Insights [Database]"),
    ("%CW:ContributorRulesManaged%", "CloudWatch Insights [Contributor]"),
    ("%CW:ContributorInsightRules%", "CloudWatch Insights [Contributor]"),
    ("%CW:ContributorInsightEvents%", "CloudWatch Insights [Contributor]"),
    ("%CW:ContributorEventsManaged%", "CloudWatch Insights [Contributor]"),
    ("%CW:InternetMonitor%", "CloudWatch Internet Monitor"),
    ("%Application-Signals-Bytes%", "CloudWatch App Signals [Bytes]"),
    ("%Application-Signals%", "CloudWatch App Signals [Requests]"),
    ("%CW:RUM-events%", "CloudWatch RUM [Events]"),
    ("%CW:RUM-free-events%", "CloudWatch RUM [Events]"),
    ("%CWNMHybrid-Paid%", "CloudWatch Network Monitor"),
    ("%Evidently%", "CloudWatch Evidently"),
]
CLOUDWATCH = like_rules("usage_type", CLOUDWATCH_PATTERNS)
CLOUDWATCH_DEFAULT = "CloudWatch [Other]"
