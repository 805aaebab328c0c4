"""Remaining usage classification rule sets (analytics, compute, management, messaging, ml,
monitoring). Fixed values: patterns and labels, first match wins."""

from __future__ import annotations

from costlake.functions.classify import like_rules

UT = "usage_type"


def L(p):  # noqa: E743
    return ("like", UT, p)


def N(p):
    return ("not", L(p))


def A(*c):
    return ("and", *c)


def O(*c):  # noqa: E743
    return ("or", *c)


# ---- analytics -------------------------------------------------------------------------------------
ATHENA = like_rules(UT, [
    ("%DataScannedInTB%", "Athena Query [Data Scanned]"),
    ("%ReservedCapacityInDPUHours%", "Athena Query [Provisioned Capacity]"),
    ("%CodeExecutionInDPUHours%", "Athena Spark [Compute]"),
])
EMR = [
    (A(L("%EMR-SERVERLESS-vCPUHours%"), N("%ARM%")), "EMR Serverless vCPU [Compute]"),
    (A(L("%EMR-SERVERLESS-MemoryGBHours%"), N("%ARM%")), "EMR Serverless Memory [Compute]"),
] + like_rules(UT, [
    ("%EMR-SERVERLESS-ARM-vCPUHours%", "EMR Serverless ARM vCPU [Compute]"),
    ("%EMR-SERVERLESS-ARM-MemoryGBHours%", "EMR Serverless ARM Memory [Compute]"),
    ("%EMR-SERVERLESS-StorageGBHours%", "EMR Serverless Storage [Storage]"),
    ("%EMR-EKS-EC2-vCPUHours%", "EMR on EKS vCPU [Compute]"),
    ("%EMR-EKS-EC2-GBHours%", "EMR on EKS Memory [Compute]"),
    ("%BoxUsage:%", "EMR EC2 Instances [Compute]"),
])
GLUE = like_rules(UT, [
    ("%Catalog-Storage%", "Glue Data Catalog Storage [Storage]"),
    ("%Catalog-Request%", "Glue Data Catalog Requests [Management]"),
]) + [(A(L("%ETL-DPU-Hour%"), N("%Flex%"), N("%MemOptimized%")), "Glue ETL Standard [Compute]")] + like_rules(UT, [
    ("%ETL-Flex-DPU-Hour%", "Glue ETL Flex [Compute]"),
    ("%ETL-MemOptimized-DPU-Hour%", "Glue ETL Memory Optimized [Compute]"),
    ("%Crawler-DPU-Hour%", "Glue Crawlers [Compute]"),
    ("%GlueInteractiveSession-DPU-Hour%", "Glue Interactive Sessions [Compute]"),
    ("%DEVED-DPU-Hour%", "Glue Development Endpoints [Compute]"),
    ("%DBrew-Node-Hour%", "Glue DataBrew Jobs [Compute]"),
    ("%DBrew-Sessions%", "Glue DataBrew Sessions [Management]"),
    ("%DBrew-FreeSessions%", "Glue DataBrew Free Sessions [Management]"),
    ("%Optimization-DPU-Hour%", "Glue Data Optimization [Compute]"),
    ("%Column-Statistics-DPU-Hour%", "Glue Column Statistics [Management]"),
])
KINESIS_ANALYTICS = [
    (A(L("%KPU-Hour%"), L("%Interactive%")), "Kinesis Analytics Interactive KPU [Compute]"),
    (A(L("%KPU-Hour%"), L("%Java%")), "Kinesis Analytics Java KPU [Compute]"),
    (A(L("%KPU-Hour%"), N("%Interactive%"), N("%Java%")), "Kinesis Analytics KPU [Compute]"),
    (A(L("%RunningApplicationStorage%"), L("%Interactive%")), "Kinesis Analytics Interactive Storage [Storage]"),
    (A(L("%RunningApplicationStorage%"), N("%Interactive%")), "Kinesis Analytics Storage [Storage]"),
    (L("%DurableApplicationBackups%"), "Kinesis Analytics Backups [Storage]"),
]
KINESIS = [
    (O(L("%ShardHour%"), L("%StreamHour%")), "Kinesis Stream Operations [Compute]"),
    (O(L("%BilledIncomingBytes%"), L("%BilledOutgoingBytes%"), L("%ReadBytes%")), "Kinesis Data Transfer [Network]"),
    (O(L("%EnhancedFanout%"), L("%EFO%")), "Kinesis Enhanced Fan-Out [Compute]"),
    (L("%Storage-ShardHour%"), "Kinesis Standard Retention [Storage]"),
    (O(L("%Extended%"), L("%LongTerm%")), "Kinesis Extended Retention [Storage]"),
    (L("%PutRequest%"), "Kinesis PUT Requests [Network]"),
]
FIREHOSE = [
    (A(L("%BilledBytes%"), N("%DFC%"), N("%Streams%"), N("%DirectPUT%"), N("%KDS%"), N("%Iceberg%"),
       N("%VendedLogs%")), "Firehose Data Processing [Processing]"),
] + like_rules(UT, [
    ("%DirectPUT-no-rounding-BilledBytes%", "Firehose Direct PUT Data [Processing]"),
    ("%KDS-no-rounding-BilledBytes%", "Firehose Kinesis Data Streams Source [Processing]"),
    ("%StreamsSourceBilledBytes%", "Firehose Streams Source Data [Processing]"),
    ("%VendedLogsBilledBytes%", "Firehose Vended Logs [Processing]"),
    ("%IcebergTablesBilledBytes%", "Firehose Iceberg Tables [Processing]"),
    ("%DFCBilledBytes%", "Firehose Data Format Conversion [Processing]"),
    ("%DPBytesDelivered%", "Firehose Data Processing Delivered [Processing]"),
    ("%DecompressionDecompressedBytes%", "Firehose Data Decompression [Processing]"),
    ("%MetadataProcessingDuration%", "Firehose Metadata Processing [Processing]"),
    ("%Firehose-VpcDelivery-Bytes%", "Firehose VPC Delivery Data [Network]"),
    ("%Firehose-VpcDelivery-Hours%", "Firehose VPC Delivery Hours [Network]"),
    ("%S3DeliveryObjectCount%", "Firehose S3 Object Count [Storage]"),
    ("%AWS-Out-Bytes%", "Firehose Inter-Region Transfer [Network]"),
    ("%AWS-In-Bytes%", "Firehose Inter-Region Transfer In [Network]"),
    ("%DataTransfer-Out-Bytes%", "Firehose Data Transfer Out [Network]"),
    ("%DataTransfer-Regional-Bytes%", "Firehose Regional Transfer [Network]"),
    ("%CloudFront-Out-Bytes%", "Firehose CloudFront Transfer [Network]"),
])
MSK = [
    (O(L("%Kafka.m%"), L("%Kafka.t3%")), "MSK Provisioned Compute [Compute]"),
    (L("%KafkaServerless-%"), "MSK Serverless Operations [Compute]"),
    (L("%Kafka.mcu%"), "MSK Connect [Compute]"),
    (L("%KafkaReplication-%"), "MSK Replicator [Management]"),
    (O(L("%Storage%"), L("%Tiered%"), L("%Throughput%")), "MSK Storage [Storage]"),
    (L("%PrivateConnectivity%"), "MSK Private Connectivity [Management]"),
    (O(L("%DataTransfer-%"), L("%AWS-In-Bytes%"), L("%AWS-Out-Bytes%"), L("%CloudFront-%")),
     "MSK Data Transfer [Network]"),
]
QUICKSIGHT = like_rules(UT, [
    ("%User-Standard%", "QuickSight Authors [Standard]"),
    ("%User-Enterprise%", "QuickSight Authors [Enterprise]"),
    ("%Author-Pro%", "QuickSight Authors Pro [Enterprise]"),
    ("%Reader-Usage%", "QuickSight Readers [Sessions]"),
    ("%Reader-Capacity%", "QuickSight Readers [Capacity]"),
    ("%Reader-Enterprise%", "QuickSight Readers [Enterprise]"),
    ("%Reader-Pro%", "QuickSight Readers [Pro]"),
    ("%SPICE", "QuickSight SPICE Storage"),
    ("%Alerts%", "QuickSight Alerts"),
    ("%Q-Query-Capacity%", "QuickSight Q Query [Capacity]"),
    ("%Amazon-Q-QS-Fee%", "QuickSight Q Monthly Fee"),
    ("%-Report%", "QuickSight Reporting"),
])

# ---- compute (besides EC2, Lambda, OS, normalisation) -------------------------------------------------
BATCH = like_rules(UT, [("%ComputeEnvironment%", "Batch Compute Environment [Compute]"),
                        ("%JobQueue%", "Batch Job Queue [Management]")])
DAX = [
    (A(L("%NodeUsage%"), L("%dax.r%")), "DAX Memory Optimized Nodes [Compute]"),
    (A(L("%NodeUsage%"), L("%dax.t%")), "DAX Burstable Nodes [Compute]"),
    (A(L("%NodeUsage%"), N("%dax.r%"), N("%dax.t%")), "DAX Nodes [Compute]"),
]
ECR = like_rules(UT, [
    ("%TimedStorage-ByteHrs%", "ECR Container Storage [Storage]"),
    ("%AWS-Out-Bytes%", "ECR Inter-Region Transfer [Network]"),
    ("%DataTransfer-Out-Bytes%", "ECR Data Transfer Out [Network]"),
    ("%DataXfer-Out%", "ECR Data Transfer Out [Network]"),
])
ECS = like_rules(UT, [
    ("%Fargate-vCPU-Hours:perCPU%", "ECS Fargate x86 vCPU [Compute]"),
    ("%Fargate-GB-Hours%", "ECS Fargate x86 Memory [Compute]"),
    ("%Fargate-ARM-vCPU-Hours:perCPU%", "ECS Fargate ARM vCPU [Compute]"),
    ("%Fargate-ARM-GB-Hours%", "ECS Fargate ARM Memory [Compute]"),
    ("%Fargate-Windows-vCPU-Hours:perCPU%", "ECS Fargate Windows vCPU [Compute]"),
    ("%Fargate-Windows-GB-Hours%", "ECS Fargate Windows Memory [Compute]"),
    ("%Fargate-Windows-OS-Hours:perCPU%", "ECS Fargate Windows OS License [Compute]"),
    ("%Fargate-EphemeralStorage-GB-Hours%", "ECS Fargate Ephemeral Storage [Storage]"),
    ("%ECS-EC2-vCPU-Hours%", "ECS EC2 vCPU [Compute]"),
    ("%ECS-EC2-GB-Hours%", "ECS EC2 Memory [Compute]"),
])
EKS = like_rules(UT, [
    ("%Fargate-vCPU-Hours:perCPU%", "EKS Fargate vCPU [Compute]"),
    ("%Fargate-GB-Hours%", "EKS Fargate Memory [Compute]"),
    ("%Fargate-EphemeralStorage-GB-Hours%", "EKS Fargate Ephemeral Storage [Storage]"),
    ("%EKS-Auto:%", "EKS Auto Management [Compute]"),
    ("%AmazonEKS-Hours:perCluster%", "EKS Cluster Standard Support [Management]"),
    ("%AmazonEKS-Hours:extendedSupport%", "EKS Cluster Extended Support [Management]"),
    ("%AmazonEKSHybridNodes-Hours:pervCPU%", "EKS Hybrid Nodes [Compute]"),
])
OUTPOSTS = like_rules(UT, [("%Outpost%", "Outposts Rack [Compute]"), ("%Instance%", "Outposts Instance [Compute]"),
                           ("%EBS%", "Outposts EBS [Storage]")])

# ---- management ------------------------------------------------------------------------------------
AWS_SUPPORT = like_rules(UT, [("%Dollar%", "AWS Support Enterprise Charges [Management]")])
# Fixed values
COMPUTE_SAVINGS_PLANS = like_rules(UT, [
    ("%ComputeSP:1yrNoUpfront%", "Compute Savings Plans 1yr No Upfront [Compute]"),
    ("%ComputeSP:1yrPartialUpfront%", "Compute Savings Plans 1yr Partial Upfront [Compute]"),
    ("%ComputeSP:1yrAllUpfront%", "Compute Savings Plans 1yr All Upfront [Compute]"),
    ("%ComputeSP:3yrNoUpfront%", "Compute Savings Plans 3yr No Upfront [Compute]"),
    ("%ComputeSP:3yrPartialUpfront%", "Compute Savings Plans 3yr Partial Upfront [Compute]"),
    ("%ComputeSP:3yrAllUpfront%", "Compute Savings Plans 3yr All Upfront [Compute]"),
    ("%SageMakerSP:1yrNoUpfront%", "SageMaker Savings Plans 1yr No Upfront [ML Compute]"),
    ("%SageMakerSP:1yrPartialUpfront%", "SageMaker Savings Plans 1yr Partial Upfront [ML Compute]"),
    ("%SageMakerSP:1yrAllUpfront%", "SageMaker Savings Plans 1yr All Upfront [ML Compute]"),
    ("%SageMakerSP:3yrNoUpfront%", "SageMaker Savings Plans 3yr No Upfront [ML Compute]"),
    ("%SageMakerSP:3yrPartialUpfront%", "SageMaker Savings Plans 3yr Partial Upfront [ML Compute]"),
    ("%SageMakerSP:3yrAllUpfront%", "SageMaker Savings Plans 3yr All Upfront [ML Compute]"),
])
COST_EXPLORER = like_rules(UT, [("%API-Request%", "Cost Explorer API Requests [Management]"),
                                ("%UsageReport%", "Cost Explorer Usage Reports [Management]")])

# ---- messaging -------------------------------------------------------------------------------------
MQ = like_rules(UT, [("%ActiveMQ-Instance%", "MQ ActiveMQ Broker Instance [Processing]"),
                     ("%RabbitMQ-Instance%", "MQ RabbitMQ Broker Instance [Processing]")]) + [
    (A(L("%Instance%"), N("%ActiveMQ%"), N("%RabbitMQ%")), "MQ Broker Instance [Processing]"),
    (L("%Storage%"), "MQ Broker Storage [Storage]"),
]
SNS = like_rules(UT, [
    ("%Requests-Tier1%", "SNS API Requests [Processing]"),
    ("%DeliveryAttempts%", "SNS Message Delivery Attempts [Processing]"),
    ("%OutboundSMS%", "SNS SMS Messages [Processing]"),
    ("%F-Request-Tier1%", "SNS FIFO Requests [Processing]"),
    ("%F-Ingress-Tier1%", "SNS FIFO Ingress [Processing]"),
    ("%F-DA-SQS%", "SNS FIFO Delivery to SQS [Processing]"),
    ("%F-Egress-SQS%", "SNS FIFO Egress to SQS [Processing]"),
    ("%F-Storage%", "SNS FIFO Message Storage [Storage]"),
    ("%F-ArchiveProcessing%", "SNS FIFO Archive Processing [Processing]"),
]) + [
    (O(L("%PL-Filter-Matched%"), L("%F-PL-Filter-Matched%")), "SNS Payload Filter Matched [Processing]"),
    (O(L("%PL-Filtered-Out%"), L("%F-PL-Filtered-Out%")), "SNS Payload Filter Excluded [Processing]"),
] + like_rules(UT, [
    ("%DataTransfer-In-Bytes%", "SNS Data Transfer In [Network]"),
    ("%DataTransfer-Out-Bytes%", "SNS Data Transfer Out [Network]"),
    ("%DataXfer-In%", "SNS Data Transfer In [Network]"),
    ("%DataXfer-Out%", "SNS Data Transfer Out [Network]"),
    ("%AWS-In-Bytes%", "SNS Inter-Region Transfer In [Network]"),
])
SQS = [
    (A(L("%Requests-Tier1%"), N("%FIFO%")), "SQS Standard Requests [Processing]"),
    (A(L("%Requests-RBP%"), N("%FIFO%")), "SQS Standard Requests with RBP [Processing]"),
] + like_rules(UT, [
    ("%Requests-FIFO-Tier1%", "SQS FIFO Requests [Processing]"),
    ("%Requests-FIFO-RBP%", "SQS FIFO Requests with RBP [Processing]"),
    ("%DataTransfer-Out-Bytes%", "SQS Data Transfer Out [Network]"),
    ("%DataTransfer-In-Bytes%", "SQS Data Transfer In [Network]"),
    ("%DataXfer-Out%", "SQS Data Transfer Out [Network]"),
    ("%DataXfer-In%", "SQS Data Transfer In [Network]"),
    ("%AWS-Out-Bytes%", "SQS Inter-Region Transfer Out [Network]"),
    ("%AWS-In-Bytes%", "SQS Inter-Region Transfer In [Network]"),
])

# ---- ml --------------------------------------------------------------------------------------------
BEDROCK = like_rules(UT, [("%-input-tokens", "Bedrock Text Model Input Tokens [AI/ML]"),
                          ("%-output-tokens", "Bedrock Text Model Output Tokens [AI/ML]")]) + [
    (A(L("%TitanImageGenerator%"), L("%T2I%")), "Bedrock Text-to-Image Generation [AI/ML]"),
    (A(L("%TitanImageGenerator%"), L("%I2I%")), "Bedrock Image-to-Image Generation [AI/ML]"),
    (A(L("%TitanEmbeddings%"), L("%Text%")), "Bedrock Text Embeddings [AI/ML]"),
    (A(L("%TitanEmbeddings%"), L("%Image%")), "Bedrock Image Embeddings [AI/ML]"),
    (A(L("%ProvisionedThroughput%"), L("%ModelUnits%")), "Bedrock Provisioned Throughput [AI/ML]"),
    (L("%Customization-Storage%"), "Bedrock Model Customization Storage [AI/ML]"),
    (L("%Guardrail-ContentPolicyUnitsConsumed%"), "Bedrock Guardrails Content Policy [Security]"),
    (A(L("%Guardrail-SensitiveInformationPolicy%"), L("%Paid%")), "Bedrock Guardrails Sensitive Info (Paid) [Security]"),
    (A(L("%Guardrail-SensitiveInformationPolicy%"), L("%Free%")), "Bedrock Guardrails Sensitive Info (Free) [Security]"),
    (L("%Guardrail-TopicPolicyUnitsConsumed%"), "Bedrock Guardrails Topic Policy [Security]"),
    (L("%Guardrail-WordPolicyUnitsConsumed%"), "Bedrock Guardrails Word Policy [Security]"),
]
SAGEMAKER = [
    (L("%VolumeUsage%"), "SageMaker Storage [Storage]"),
    (O(L("%Train:%"), L("%Processing:%"), L("%Tsform:%"), L("%TrSpt:%")), "SageMaker Training & Processing [Compute]"),
    (O(L("%Host:%"), L("%ServerlessInf:%"), L("%AsyncInf:%"), L("%ProvisionedConcurrency:%")),
     "SageMaker Inference [Compute]"),
    (O(L("%Notebk:%"), L("%Studio:%")), "SageMaker Development [Compute]"),
    (L("%Cluster:%"), "SageMaker HyperPod [Compute]"),
    (L("%FeatureStore:%"), "SageMaker Feature Store [Management]"),
    (O(L("%Canvas:%"), L("%MLflow:%"), L("%Geospatial:%"), L("%TensorBoard:%")),
     "SageMaker Managed Services [Management]"),
    (O(L("%DataTransfer-%"), L("%Data-Bytes%")), "SageMaker Data Transfer [Network]"),
]

# ---- monitoring --------------------------------------------------------------------------------------
XRAY = like_rules(UT, [("%XRay-TracesStored%", "X-Ray Traces Stored [Monitoring]"),
                       ("%XRay-TracesAccessed%", "X-Ray Traces Retrieved [Monitoring]"),
                       ("%XRay-InsightsTracesStored%", "X-Ray Insights Traces [Monitoring]")])
