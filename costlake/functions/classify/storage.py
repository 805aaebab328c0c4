"""Storage rule sets. Patterns and labels, first match wins."""

from __future__ import annotations

from costlake.functions.classify import like_rules

UT, OP = "usage_type", "operation"

# ---- EBS: the part of the usage type after 'EBS:' -----------------------------------------------
EBS_PARTS = [
    ("VolumeUsage.gp3", "EBS Volume gp3 [Storage]"),
    ("VolumeUsage.gp2", "EBS Volume gp2 [Storage]"),
    ("VolumeUsage.io2", "EBS Volume io2 [Storage]"),
    ("VolumeUsage.piops", "EBS Volume io1 [Storage]"),
    ("VolumeUsage.st1", "EBS Volume st1 [Storage]"),
    ("VolumeUsage.sc1", "EBS Volume sc1 [Storage]"),
    ("VolumeUsage", "EBS Volume magnetic [Storage]"),
    ("VolumeP-IOPS.gp3", "EBS Volume gp3 [IOPS]"),
    ("VolumeP-IOPS.io2", "EBS Volume io2 [IOPS]"),
    ("VolumeP-IOPS.io2.tier2", "EBS Volume io2 [IOPS]"),
    ("VolumeP-IOPS.io2.tier3", "EBS Volume io2 [IOPS]"),
    ("VolumeP-IOPS.piops", "EBS Volume io1 [IOPS]"),
    ("VolumeIOUsage", "EBS Volume magnetic [IO]"),
    ("VolumeP-Throughput.gp3", "EBS Volume gp3 [Throughput]"),
    ("SnapshotUsage", "EBS Volume snapshot [Storage]"),
    ("SnapshotArchiveStorage", "EBS Volume snapshot archive [Storage]"),
    ("SnapshotArchiveEarlyDelete", "EBS Volume snapshot archive [Early Delete]"),
    ("SnapshotArchiveRetrieval", "EBS Volume snapshot archive [Retrieval]"),
    ("FastSnapshotRestore", "EBS Volume snapshot [Fast Restore]"),
    ("directAPI.snapshot.List", "EBS Volume snapshot [Direct API]"),
    ("directAPI.snapshot.Get", "EBS Volume snapshot [Direct API]"),
    ("directAPI.snapshot.Put", "EBS Volume snapshot [Direct API]"),
]
# non-EBS rows get NULL; EBS rows whose part is unknown get 'EBS [Other]'
EBS = [(("and", ("like", UT, "%EBS:%"), ("eq", ("split_part", UT, ":", 2), part)), label)
       for part, label in EBS_PARTS]
EBS_OTHER = "EBS [Other]"
EBS += [(("like", UT, "%EBS:%"), EBS_OTHER)]
EBS_DEFAULT = None

# ---- EBS volume type of the monthly summary ------------------------------------------------------
EBS_VOLUME_TYPE = like_rules("usage_category", [
    ("%gp3%", "gp3"), ("%gp2%", "gp2"), ("%io2%", "io2"), ("%io1%", "io1"), ("%st1%", "st1"),
    ("%sc1%", "sc1"), ("%magnetic%", "magnetic"), ("%snapshot%", "snapshot"),
])
EBS_VOLUME_TYPE_DEFAULT = "other"

# ---- S3 -------------------------------------------------------------------------------------------
# Fixed values, tried in this order
S3 = [
    (("eq", OP, "StandardStorage"), "S3 Standard [Storage]"),
    (("eq", OP, "IntelligentTieringAAStorage"), "S3 Intelligent Tiering (Archive Access) [Storage]"),
    (("eq", OP, "IntelligentTieringAIAStorage"), "S3 Intelligent Tiering (Archive Instant Access) [Storage]"),
    (("eq", OP, "IntelligentTieringDAAStorage"), "S3 Intelligent Tiering (Deep Archive Access) [Storage]"),
    (("eq", OP, "IntelligentTieringFAStorage"), "S3 Intelligent Tiering (Frequent Access) [Storage]"),
    (("eq", OP, "IntelligentTieringIAStorage"), "S3 Intelligent Tiering (Infrequent Access) [Storage]"),
    (("eq", OP, "IntelligentTieringStorage"), "S3 Intelligent Tiering [Monitoring & Automation]"),
    (("eq", OP, "S3-INTTransition"), "S3 Intelligent Tiering [Initial Transition]"),
    (("eq", OP, "IntAAObjectOverhead"), "S3 Intelligent Tiering (Archive Access) [Overhead]"),
    (("eq", OP, "IntAAS3ObjectOverhead"), "S3 Intelligent Tiering (Archive Access) [Overhead]"),
    (("eq", OP, "IntDAAObjectOverhead"), "S3 Intelligent Tiering (Deep Archive Access) [Overhead]"),
    (("eq", OP, "IntDAAS3ObjectOverhead"), "S3 Intelligent Tiering (Deep Archive Access) [Overhead]"),
    (("eq", OP, "OneZoneFAStorage"), "S3 One Zone Infrequent Access [Frequent Access Storage]"),
    (("eq", OP, "OneZoneIAStorage"), "S3 One Zone Infrequent Access [Storage]"),
    (("eq", OP, "OneZoneIAAAStorage"), "S3 One Zone Infrequent Access [Archive Access Storage]"),
    (("eq", OP, "OneZoneAIAStorage"), "S3 One Zone Infrequent Access [Archive Instant Access Storage]"),
    (("eq", OP, "OneZoneDAAStorage"), "S3 One Zone Infrequent Access [Deep Archive Access Storage]"),
    (("eq", OP, "OneZoneIASizeOverhead"), "S3 One Zone Infrequent Access [Overhead]"),
    (("eq", OP, "S3-ZIATransition"), "S3 One Zone Infrequent Access [Initial Transition]"),
    (("eq", OP, "StandardIAStorage"), "S3 Standard Infrequent Access [Storage]"),
    (("eq", OP, "StandardIASizeOverhead"), "S3 Standard Infrequent Access [Overhead]"),
    (("eq", OP, "S3-SIATransition"), "S3 Standard Infrequent Access [Initial Transition]"),
    (("eq", OP, "ExpressOneZoneStorage"), "S3 Express One Zone [Storage]"),
    (("eq", OP, "GlacierInstantRetrievalStorage"), "S3 Glacier Instant Retrieval [Storage]"),
    (("eq", OP, "GlacierInstantRetrievalSizeOverhead"), "S3 Glacier Instant Retrieval [Overhead]"),
    (("eq", OP, "GlacierStorage"), "S3 Glacier Flexible [Storage]"),
    (("eq", OP, "GlacierStagingStorage"), "S3 Glacier Flexible [Storage]"),
    (("eq", OP, "GlacierObjectOverhead"), "S3 Glacier Flexible [Overhead]"),
    (("eq", OP, "GlacierS3ObjectOverhead"), "S3 Glacier Flexible [Overhead]"),
    (("eq", OP, "RestoreObject"), "S3 Glacier [Restore]"),
    (("eq", OP, "S3-GlacierTransition"), "S3 Glacier [Initial Transition]"),
    (("eq", OP, "DeepArchiveStorage"), "S3 Glacier Deep Archive [Storage]"),
    (("eq", OP, "DeepArchiveStagingStorage"), "S3 Glacier Deep Archive [Storage]"),
    (("eq", OP, "DeepArchiveObjectOverhead"), "S3 Glacier Deep Archive [Overhead]"),
    (("eq", OP, "DeepArchiveS3ObjectOverhead"), "S3 Glacier Deep Archive [Overhead]"),
    (("eq", OP, "DeepArchiveRestoreObject"), "S3 Glacier Deep Archive [Restore]"),
    (("eq", OP, "ReducedRedundancyStorage"), "S3 Reduced Redundancy [Storage]"),
    (("eq", OP, "InitiateMultipartUpload"), "S3 Multipart Upload [Initiated]"),
    (("eq", OP, "CompleteMultipartUpload"), "S3 Multipart Upload [Completed]"),
    (("like", OP, "%StorageLens%"), "S3 Storage Lens"),
    (("like", OP, "Compaction"), "S3 Table Compaction"),
    (("like", UT, "%SIA-Tier1%"), "S3 Standard Infrequent Access [Requests Tier1]"),
    (("like", UT, "%SIA-Tier2%"), "S3 Standard Infrequent Access [Requests Tier2]"),
    (("like", UT, "%GIR-Tier1%"), "S3 Glacier Instant Retrieval [Requests Tier1]"),
    (("like", UT, "%GIR-Tier2%"), "S3 Glacier Instant Retrieval [Requests Tier2]"),
    (("like", UT, "%ZIA-Tier1%"), "S3 One Zone Infrequent Access [Requests Tier1]"),
    (("like", UT, "%ZIA-Tier2%"), "S3 One Zone Infrequent Access [Requests Tier2]"),
    (("like", UT, "%-Tier1"), "S3 Requests [PUT, COPY, POST, LIST, UPLOAD]"),
    (("like", UT, "%-Tier2"), "S3 Requests [GET and all other]"),
    (("like", UT, "%-Tier3"), "S3 Lifecycle [Requests]"),
    (("like", UT, "%-Tier4"), "S3 Lifecycle [Transitions]"),
    (("or", ("like", UT, "%AWS-In-Bytes%"), ("like", UT, "%AWS-Out-Bytes%")), "S3 Data Transfer [Inter-Region]"),
    (("or", ("like", UT, "%DataXfer-In%"), ("like", UT, "%DataXfer-Out%")), "S3 Data Transfer [Direct Connect]"),
    (("like", UT, "%CloudFront-Out-Bytes"), "S3 Data Transfer to CloudFront [Out]"),
    (("like", UT, "%CloudFront-In-Bytes"), "S3 Data Transfer to CloudFront [In]"),
    (("like", UT, "%DataTransfer-In-Bytes"), "S3 Data Transfer [Internet In]"),
    (("like", UT, "%DataTransfer-Out-Bytes"), "S3 Data Transfer [Internet Out]"),
    (("like", UT, "%AWS-Out-ABytes%"), "S3 Accelerated Data Transfer Out [Inter-Region Out]"),
    (("like", UT, "%AWS-In-ABytes%"), "S3 Accelerated Data Transfer In [Inter-Region In]"),
    (("like", UT, "%DataTransfer%"), "S3 Data Transfer [Accelerated]"),
    (("like", UT, "%StorageAnalytics%"), "S3 Analytics"),
    (("like", UT, "%BatchOperations%"), "S3 Batch Operations"),
    (("like", UT, "%S3RTC%"), "S3 Replication Time Control"),
    (("like", UT, "%TagStorage%"), "S3 Tags"),
    (("like", UT, "%Select%"), "S3 Select"),
    (("like", UT, "%Inventory%"), "S3 Inventory List"),
    (("like", UT, "%MRAP%"), "S3 Multi-Region Access Point"),
    (("like", UT, "%Retrieval-SIA%"), "S3 Standard Infrequent Access [Retrieval]"),
    (("like", UT, "%Retrieval-GIR%"), "S3 Glacier Instant Retrieval [Retrieval]"),
    (("like", UT, "%Retrieval%"), "S3 One Zone Infrequent Access [Retrieval]"),
    (("like", UT, "%EarlyDelete-ZIA%"), "S3 One Zone Infrequent Access [Early Delete]"),
    (("like", UT, "%EarlyDelete-GIR%"), "S3 Glacier Instant Retrieval [Early Delete]"),
    (("like", UT, "%EarlyDelete-ByteHrs"), "S3 Glacier [Early Delete]"),
    (("like", UT, "%EarlyDelete-GDA%"), "S3 Glacier Deep Archive [Early Delete]"),
    (("like", UT, "%EarlyDelete-SIA%"), "S3 Standard Infrequent Access [Early Delete]"),
    (("like", UT, "%Requests-GDA%"), "S3 Glacier Deep Archive [Restore Requests]"),
    (("like", UT, "%Requests-Tier6%"), "S3 Glacier Flexible Retrieval [Restore Requests]"),
]
S3_DEFAULT = "S3 [Other]"

# ---- S3 bucket name keywords (word-boundary regexes on the lower-cased name) ---------------------
BUCKET_KEYWORDS = [
    (r"\b(backup|bak|bkp|snapshot|snap)\b", "backup"),
    (r"\b(datalake|data-lake|lake)\b", "datalake"),
    (r"\b(source|raw|ingest|landing)\b", "source"),
    (r"\b(archive|cold|glacier|ia)\b", "archive"),
    (r"\b(analytics|data|warehouse|dwh|etl|pipeline)\b", "analytics"),
    (r"\b(processed|curated|prepared|transformed)\b", "processed"),
    (r"\b(media|image|video|photo|asset|content)\b", "media"),
    (r"\b(document|doc|file|pdf|office)\b", "document"),
    (r"\b(web|www|static|frontend|ui)\b", "web"),
    (r"\b(log|audit|trail|event)\b", "logging"),
    (r"\b(temp|tmp|staging|stage|test|dev|sandbox|qa)\b", "temp"),
    (r"\b(config|setting|env|parameter|secret)\b", "config"),
    (r"\b(upload|incoming|input)\b", "uploads"),
    (r"\b(export|outgoing|output|extract)\b", "export"),
    (r"\b(import|ingest)\b", "import"),
    (r"\b(replication|replica|sync|mirror)\b", "replication"),
    (r"\b(user|client|customer)\b", "user_data"),
    (r"\b(public|shared|common|global)\b", "public"),
    (r"\b(private|internal|corp|company)\b", "private"),
    (r"\b(ml|model|sagemaker|train|inference|ai)\b", "ml"),
    (r"\b(report|dash|dashboard|bi|viz)\b", "reporting"),
    (r"\b(cdn|edge|distribution)\b", "cdn"),
    (r"\b(cache|redis|mem)\b", "cache"),
    (r"\b(historical|history|legacy|old)\b", "historical"),
    (r"\b(system|service|infra|infrastructure)\b", "system"),
    (r"\b(compliance|legal|governance)\b", "compliance"),
    (r"\b(security|sec|vault|encryption)\b", "security"),
]
_BN = ("lower", "bucket_name")
BUCKET_NAME = ([(("and", ("rlike", _BN, r"\b(athena)\b"), ("rlike", _BN, r"\b(results|query)\b")), "athena_results")]
               + [(("rlike", _BN, rx), label) for rx, label in BUCKET_KEYWORDS])
BUCKET_NAME_DEFAULT = "none"

# ---- EFS ----------------------------------------------------------------------------------------------
EFS = like_rules(UT, [("%TimedStorage-%", "EFS Standard Storage [Storage]"),
                      ("%IATimedStorage-%", "EFS Infrequent Access Storage [Storage]")]) + [
    (("or", ("like", UT, "%ArchiveTimedStorage-%"), ("like", UT, "%ArchiveEarlyDelete-%")), "EFS Archive Storage [Storage]"),
] + like_rules(UT, [("%DataAccess-Bytes%", "EFS Data Access [Management]"), ("%TP-MiBpsHrs%", "EFS Throughput [Management]"),
                    ("%AWS-Out-Bytes%", "EFS Data Transfer [Network]")])
