"""Database rule sets (one per service). Patterns and labels, first match wins."""

from __future__ import annotations

from costlake.functions.classify import like_rules

UT, ENGINE = "usage_type", "engine"


def _rds(suffix: str):
    return ("concat", "RDS ", ("col", ENGINE), f" {suffix}")


RDS_PATTERNS = [
    ("%InstanceUsage%", "Instance Single-AZ [Compute]"),
    ("%Multi-AZUsage%", "Instance Multi-AZ [Compute]"),
    ("%MirrorUsage%", "Instance Multi-AZ [Compute]"),
    ("%ProxyUsage%", "Proxy [Compute]"),
    ("%Aurora:StorageUsage%", "Storage [Storage]"),
    ("%Aurora:StorageIOUsage%", "I/O [Management]"),
    ("%GP2-Storage%", "GP2 Storage [Storage]"),
    ("%GP3-Storage%", "GP3 Storage [Storage]"),
    ("%StorageUsage%", "Magnetic Storage [Storage]"),
    ("%Aurora:BackupUsage%", "Backup [Storage]"),
    ("%ChargedBackupUsage%", "Backup [Storage]"),
    ("%Aurora:ServerlessV2Usage%", "Serverless V2 [Compute]"),
    ("%Aurora:ServerlessUsage%", "Serverless [Compute]"),
    ("%Multi-AZClusterUsage%", "Instance Multi-AZ readable standby [Compute]"),
    ("%Aurora:ServerlessV2IOOptimizedUsage%", "Serverless V2 IO Optimized [Compute]"),
    ("%PIOPS-Storage-IO2%", "io2 Storage [Storage]"),
    ("%PIOPS-Storage%", "io1 Storage [Storage]"),
    ("%IO2-PIOPS%", "io2 PIOPS [Storage]"),
    ("%PIOPS%", "io1 PIOPS [Storage]"),
    ("%GP3-PIOPS%", "GP3 PIOPS [Storage]"),
    ("%GP3-Throughput%", "GP3 Provisioned Throughput [Storage]"),
    ("%Aurora:IO-OptimizedStorageUsage%", "I/O Optimized Storage [Storage]"),
    ("%Aurora:ReplicatedWriteIO%", "Replicated Write I/Os [Management]"),
    ("%Aurora:BacktrackUsage%", "Backtrack Change Records [Management]"),
]
RDS = [(("like", UT, p), _rds(s)) for p, s in RDS_PATTERNS] + [(("like", UT, "%ExtendedSupport%"),
                                                                 "RDS Extended Support [Fee]")]
RDS_DEFAULT = "RDS [Other]"

DYNAMODB = like_rules(UT, [
    ("%RequestUnit%", "DynamoDB On-Demand Capacity [Compute]"),
    ("%CapacityUnit%", "DynamoDB Provisioned Capacity [Compute]"),
    ("%HeavyUsage%", "DynamoDB Provisioned Capacity [Compute]"),
    ("%TimedStorage%", "DynamoDB Storage [Storage]"),
    ("%TimedBackup%", "DynamoDB Backups [Storage]"),
    ("%TimedPITR%", "DynamoDB Backups [Storage]"),
    ("%ExportDataSize-Bytes%", "DynamoDB S3 Export [Network]"),
    ("%ImportDataSize-Bytes%", "DynamoDB S3 Import [Network]"),
    ("%RestoreDataSize-Bytes%", "DynamoDB Restored Backups [Storage]"),
])
DYNAMODB_DEFAULT = "DynamoDB [Other]"

ELASTICACHE = like_rules(UT, [
    ("%NodeUsage:cache.%", "ElastiCache Cache Nodes [Compute]"),
    ("%Outpost-NodeUsage:%", "ElastiCache Outpost Nodes [Compute]"),
    ("%ElastiCacheProcessingUnits:%", "ElastiCache Serverless Processing Units [Compute]"),
    ("%CachedData:%", "ElastiCache Serverless Storage [Storage]"),
    ("%BackupUsage:Redis%", "ElastiCache Redis Backup Storage [Storage]"),
    ("%BackupUsage:Valkey%", "ElastiCache Valkey Backup Storage [Storage]"),
    ("%ElastiCache:BackupUsage%", "ElastiCache Backup Storage [Storage]"),
    ("%ElastiCache-Out-Bytes%", "ElastiCache Data Transfer Out [Network]"),
])
ELASTICACHE_DEFAULT = "ElastiCache [Other]"

OPENSEARCH = like_rules(UT, [
    ("%ESInstance%", "OpenSearch Instance [Compute]"),
    ("%GP3-Storage%", "OpenSearch GP3 Storage [Storage]"),
    ("%GP2-Storage%", "OpenSearch GP2 Storage [Storage]"),
    ("%Managed-Storage%", "OpenSearch Managed Storage [Storage]"),
    ("%IndexingOCU%", "OpenSearch Serverless [Compute]"),
    ("%SearchOCU%", "OpenSearch Serverless [Compute]"),
    ("%StorageUsedInS3ByteHour%", "OpenSearch Serverless [Storage]"),
    ("%GP3-PIOPS%", "OpenSearch GP3 PIOPS [Storage]"),
    ("%GP3-Throughput%", "OpenSearch GP3 Provisioned ThroughPut [Storage]"),
    ("%GP3-Provisioned-Throughput%", "OpenSearch GP3 Provisioned ThroughPut [Storage]"),
    ("%PIOPS-Storage%", "OpenSearch PIOPS Storage [Storage]"),
    ("%PIOPS%", "OpenSearch PIOPS [Storage]"),
    ("%Magnetic-Storage%", "OpenSearch Magnetic Storage [Storage]"),
    ("%IngestionOCU%", "OpenSearch Ingestion [Compute]"),
])
OPENSEARCH_DEFAULT = "OpenSearch [Other]"

REDSHIFT = like_rules(UT, [
    ("%Node%", "Redshift Instance [Compute]"),
    ("%ServerlessUsage%", "Redshift Serverless [Compute]"),
    ("%RMS%", "Redshift Managed Storage [Storage]"),
    ("%CS%", "Redshift Concurrency Scaling [Compute]"),
    ("%DataScanned%", "Redshift Data Scanned [Management]"),
    ("%Redshift:PaidSnapshots%", "Redshift Snapshots [Storage]"),
    ("%InterRegionSnapshotCopy%", "Redshift Snapshots [Storage]"),
])
REDSHIFT_DEFAULT = "Redshift [Other]"

DOCUMENTDB = like_rules(UT, [
    ("%InstanceUsage%", "DocumentDB Instance [Compute]"),
    ("%StorageUsage%", "DocumentDB Storage [Storage]"),
    ("%StorageIOUsage%", "DocumentDB I/O [Management]"),
    ("%ElasticCPUUsage%", "DocumentDB Utilization [Compute]"),
    ("%BackupUsage%", "DocumentDB Storage Snapshot [Storage]"),
])
DOCUMENTDB_DEFAULT = "DocumentDB [Other]"

MEMORYDB = [
    (("like", UT, "%NodeUsage%"), ("concat", "MemoryDB ", ("col", ENGINE), " Instance [Compute]")),
    (("like", UT, "%DataWritten%"), ("concat", "MemoryDB ", ("col", ENGINE), " Write [Storage]")),
    (("like", UT, "%SnapshotUsage%"), ("concat", "MemoryDB ", ("col", ENGINE), " Snapshot [Storage]")),
]
MEMORYDB_DEFAULT = "MemoryDB [Other]"

NEPTUNE = like_rules(UT, [
    ("%InstanceUsage%", "Neptune Instance [Compute]"),
    ("%GraphUsage%", "Neptune Instance [Compute]"),
    ("%StorageUsage%", "Neptune Data [Storage]"),
    ("%StorageIOUsage%", "Neptune I/O [Management]"),
    ("%Serverless%", "Neptune Serverless [Compute]"),
    ("%BackupUsage%", "Neptune Snapshot [Storage]"),
    ("%GraphSnapshot%", "Neptune Snapshot [Storage]"),
])
NEPTUNE_DEFAULT = "Neptune [Other]"

# service code -> (rules, default): the per-service dispatch of the database summary
BY_SERVICE = {
    "AmazonRDS": (RDS, RDS_DEFAULT),
    "AmazonDynamoDB": (DYNAMODB, DYNAMODB_DEFAULT),
    "AmazonElastiCache": (ELASTICACHE, ELASTICACHE_DEFAULT),
    "AmazonES": (OPENSEARCH, OPENSEARCH_DEFAULT),
    "AmazonRedshift": (REDSHIFT, REDSHIFT_DEFAULT),
    "AmazonDocDB": (DOCUMENTDB, DOCUMENTDB_DEFAULT),
    "AmazonMemoryDB": (MEMORYDB, MEMORYDB_DEFAULT),
    "AmazonNeptune": (NEPTUNE, NEPTUNE_DEFAULT),
}
