"""Billing-export-shaped test input projected from the driver's TPC-H-style tables.

This only *shapes* rows: every line item of ``lineitem`` becomes one billing line item with the
column names and types of a flat (CUR 1.0 style) export. Which service/usage type a row gets is
chosen by a modulus of its keys over a small catalogue of line templates; costs come from the
line's price, discount and quantity (as DECIMAL so that sums are exact in every engine). None of the
pricing, mapping or aggregation work of the models happens here.

The same SQL text runs on Spark (over temp views of the parquet files) and on DuckDB (the oracle),
so both sides read identical input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# One row per line template:
# tid, product code, product servicecode, product family, usage type (region prefix added later),
# operation, resource template ({r}=region, {a}=account; '' = no resource), instance type,
# database engine, cache engine, processor, operating system, architecture, vcpu, memory,
# pricing unit, line description, volume api name, attachment type, product name,
# normalization factor, license model, tenancy, billing entity
TEMPLATES = [
    (0, "AmazonEC2", "AmazonEC2", "Compute Instance", "BoxUsage:m5.large", "RunInstances", "i-0a", "m5.large", "", "", "Intel Xeon Platinum 8175", "Linux", "x86_64", "2", "8 GiB", "Hrs", "$0.096 per On Demand Linux m5.large Instance Hour", "", "", "", "4", "No License required", "Shared", "AWS"),
    (1, "AmazonEC2", "AmazonEC2", "Compute Instance", "BoxUsage:m6g.xlarge", "RunInstances:0002", "i-0b", "m6g.xlarge", "", "", "AWS Graviton2 Processor", "Windows", "arm64", "4", "16 GiB", "Hrs", "$0.30 per On Demand Windows m6g.xlarge Instance Hour", "", "", "", "8", "License Included", "Shared", "AWS"),
    (2, "AmazonEC2", "AmazonEC2", "Compute Instance", "SpotUsage:c5.2xlarge", "RunInstances:SV001", "i-0c", "c5.2xlarge", "", "", "Intel Xeon Platinum 8124M", "Linux", "x86_64", "8", "16 GiB", "Hrs", "c5.2xlarge Linux/UNIX Spot Instance-hour in US East", "", "", "", "16", "No License required", "Shared", "AWS"),
    (3, "AmazonEC2", "AmazonEC2", "Compute Instance", "BoxUsage:r5a.large", "RunInstances:0010", "i-0d", "r5a.large", "", "", "AMD EPYC 7571", "RHEL", "x86_64", "2", "16 GiB", "Hrs", "$0.18 per On Demand RHEL r5a.large Instance Hour", "", "", "", "4", "No License required", "Dedicated", "AWS"),
    (4, "AmazonEC2", "AmazonEC2", "Compute Instance", "BoxUsage:t3.micro", "RunInstances", "i-0e", "t3.micro", "", "", "Intel Skylake E5 2686 v5", "Linux", "x86_64", "2", "1 GiB", "Hrs", "$0.0104 per On Demand Linux t3.micro Instance Hour", "", "", "", "0.5", "No License required", "Shared", "AWS"),
    (5, "AmazonEC2", "AmazonEC2", "Storage", "EBS:VolumeUsage.gp2", "CreateVolume-Gp2", "vol-0a", "", "", "", "", "", "", "", "", "GB-Mo", "$0.10 per GB-month of General Purpose SSD (gp2) provisioned storage", "gp2", "", "", "", "", "", "AWS"),
    (6, "AmazonEC2", "AmazonEC2", "Storage", "EBS:VolumeUsage.gp3", "CreateVolume-Gp3", "vol-0b", "", "", "", "", "", "", "", "", "GB-Mo", "$0.08 per GB-month of General Purpose SSD (gp3) provisioned storage", "gp3", "", "", "", "", "", "AWS"),
    (7, "AmazonEC2", "AmazonEC2", "System Operation", "EBS:VolumeP-IOPS.io2", "CreateVolume-io2", "vol-0c", "", "", "", "", "", "", "", "", "IOPS-Mo", "$0.065 per IOPS-month provisioned io2", "io2", "", "", "", "", "", "AWS"),
    (8, "AmazonEC2", "AmazonEC2", "Provisioned Throughput", "EBS:VolumeP-Throughput.gp3", "CreateVolume-Gp3", "vol-0b", "", "", "", "", "", "", "", "", "GiBps-mo", "$0.040 per provisioned MiBps-month of gp3", "gp3", "", "", "", "", "", "AWS"),
    (9, "AmazonEC2", "AmazonEC2", "Storage Snapshot", "EBS:SnapshotUsage", "CreateSnapshot", "arn:aws:ec2:{r}:{a}:snapshot/snap-0", "", "", "", "", "", "", "", "", "GB-Mo", "$0.05 per GB-Month of snapshot data stored", "", "", "", "", "", "", "AWS"),
    (10, "AmazonEC2", "AmazonEC2", "NAT Gateway", "NatGateway-Hours", "NatGateway", "arn:aws:ec2:{r}:{a}:natgateway/nat-0", "", "", "", "", "", "", "", "", "Hrs", "$0.045 per NAT Gateway Hour", "", "", "", "", "", "", "AWS"),
    (11, "AmazonEC2", "AmazonEC2", "NAT Gateway", "NatGateway-Bytes", "NatGateway", "arn:aws:ec2:{r}:{a}:natgateway/nat-0", "", "", "", "", "", "", "", "", "GB", "$0.045 per GB Data Processed by NAT Gateways", "", "", "", "", "", "", "AWS"),
    (12, "AmazonEC2", "AWSDataTransfer", "Data Transfer", "DataTransfer-Regional-Bytes", "InterZone-In", "i-0a", "", "", "", "", "", "", "", "", "GB", "$0.010 per GB - regional data transfer - in/out/between EC2 AZs", "", "", "", "", "", "", "AWS"),
    (13, "AmazonEC2", "AWSDataTransfer", "Data Transfer", "DataTransfer-Regional-Bytes", "InterZone-Out", "i-0b", "", "", "", "", "", "", "", "", "GB", "$0.010 per GB - regional data transfer - in/out/between EC2 AZs", "", "", "", "", "", "", "AWS"),
    (14, "AmazonEC2", "AWSDataTransfer", "Data Transfer", "DataTransfer-Out-Bytes", "RunInstances", "i-0c", "", "", "", "", "", "", "", "", "GB", "$0.09 per GB - first 10 TB / month data transfer out", "", "", "", "", "", "", "AWS"),
    (15, "AmazonEC2", "AmazonEC2", "Compute Instance", "Reservation:m5.large", "RunInstances", "arn:aws:ec2:{r}:{a}:capacity-reservation/cr-0", "m5.large", "", "", "Intel Xeon Platinum 8175", "Linux", "x86_64", "2", "8 GiB", "Hrs", "Reservation Linux/UNIX m5.large Instance Hour", "", "", "", "4", "No License required", "Shared", "AWS"),
    (16, "AmazonEC2", "AmazonEC2", "Compute Instance", "UnusedBox:m5.large", "RunInstances", "arn:aws:ec2:{r}:{a}:capacity-reservation/cr-0", "m5.large", "", "", "Intel Xeon Platinum 8175", "Linux", "x86_64", "2", "8 GiB", "Hrs", "Unused Reservation Linux/UNIX m5.large Instance Hour", "", "", "", "4", "No License required", "Shared", "AWS"),
    (17, "AmazonVPC", "AmazonVPC", "IP Address", "PublicIPv4:InUseAddress", "AssociateAddressVPC", "arn:aws:ec2:{r}:{a}:ipv4pool-ec2/ip-", "", "", "", "", "", "", "", "", "Hrs", "$0.005 per In-use public IPv4 address per hour", "", "", "", "", "", "", "AWS"),
    (18, "AmazonVPC", "AmazonVPC", "IP Address", "PublicIPv4:IdleAddress", "AllocateAddressVPC", "arn:aws:ec2:{r}:{a}:ipv4pool-ec2/ip-", "", "", "", "", "", "", "", "", "Hrs", "$0.005 per Idle public IPv4 address per hour", "", "", "", "", "", "", "AWS"),
    (19, "AmazonVPC", "AmazonVPC", "VpcEndpoint", "VpcEndpoint-Hours", "VpcEndpoint", "arn:aws:ec2:{r}:{a}:vpc-endpoint/vpce-0", "", "", "", "", "", "", "", "", "Hrs", "$0.01 per VPC Endpoint Hour", "", "", "", "", "", "", "AWS"),
    (20, "AmazonVPC", "AmazonVPC", "VpcEndpoint", "VpcEndpoint-Bytes", "VpcEndpoint", "arn:aws:ec2:{r}:{a}:vpc-endpoint/vpce-0", "", "", "", "", "", "", "", "", "GB", "$0.01 per GB Data Processed by VPC Endpoints", "", "", "", "", "", "", "AWS"),
    (21, "AmazonVPC", "AmazonVPC", "Transit Gateway", "TransitGateway-Hours", "TransitGatewayVPC", "arn:aws:ec2:{r}:{a}:transit-gateway-attachment/tgw-attach-0", "", "", "", "", "", "", "", "", "hour", "$0.05 per TransitGateway attachment hour", "", "VPC", "", "", "", "", "AWS"),
    (22, "AmazonVPC", "AmazonVPC", "Transit Gateway", "TransitGateway-Bytes", "TransitGatewayVPC", "arn:aws:ec2:{r}:{a}:transit-gateway-attachment/tgw-attach-0", "", "", "", "", "", "", "", "", "GigaBytes", "$0.02 per GB - TransitGateway data processed", "", "VPC", "", "", "", "", "AWS"),
    (23, "AmazonS3", "AmazonS3", "Storage", "TimedStorage-ByteHrs", "StandardStorage", "team-data-", "", "", "", "", "", "", "", "", "GB-Mo", "$0.023 per GB - first 50 TB / month of storage used", "", "", "", "", "", "", "AWS"),
    (24, "AmazonS3", "AmazonS3", "API Request", "Requests-Tier1", "PutObject", "team-data-", "", "", "", "", "", "", "", "", "Requests", "$0.005 per 1,000 PUT, COPY, POST, or LIST requests", "", "", "", "", "", "", "AWS"),
    (25, "AmazonS3", "AmazonS3", "API Request", "Requests-Tier2", "GetObject", "team-data-", "", "", "", "", "", "", "", "", "Requests", "$0.004 per 10,000 GET and all other requests", "", "", "", "", "", "", "AWS"),
    (26, "AmazonS3", "AmazonS3", "Storage", "TimedStorage-SIA-ByteHrs", "StandardIAStorage", "logs-archive-", "", "", "", "", "", "", "", "", "GB-Mo", "$0.0125 per GB-Month of storage used in Standard-Infrequent Access", "", "", "", "", "", "", "AWS"),
    (27, "AmazonS3", "AmazonS3", "Storage", "TimedStorage-GIR-ByteHrs", "GlacierInstantRetrievalStorage", "backup-", "", "", "", "", "", "", "", "", "GB-Mo", "$0.004 per GB-Month of Glacier Instant Retrieval storage", "", "", "", "", "", "", "AWS"),
    (28, "AmazonRDS", "AmazonRDS", "Database Instance", "InstanceUsage:db.r6g.large", "CreateDBInstance:0021", "arn:aws:rds:{r}:{a}:db:aurora-prod-", "db.r6g.large", "Aurora PostgreSQL", "", "AWS Graviton2", "", "arm64", "2", "16 GiB", "Hrs", "$0.26 per RDS db.r6g.large instance hour running Aurora PostgreSQL", "", "", "", "4", "No license required", "", "AWS"),
    (29, "AmazonRDS", "AmazonRDS", "System Operation", "Aurora:StorageIOUsage", "CreateDBInstance:0021", "arn:aws:rds:{r}:{a}:cluster:aurora-prod-", "", "Aurora PostgreSQL", "", "", "", "", "", "", "IOs", "$0.20 per 1 million I/O requests", "", "", "", "", "", "", "AWS"),
    (30, "AmazonRDS", "AmazonRDS", "Database Storage", "Aurora:StorageUsage", "CreateDBInstance:0021", "arn:aws:rds:{r}:{a}:cluster:aurora-prod-", "", "Aurora PostgreSQL", "", "", "", "", "", "", "GB-Mo", "$0.10 per GB-month of storage used by Aurora", "", "", "", "", "", "", "AWS"),
    (31, "AmazonRDS", "AmazonRDS", "Database Instance", "ExtendedSupport:Yr1-Yr2:MySQL5.7", "CreateDBInstance:0002", "arn:aws:rds:{r}:{a}:db:mysql-legacy-", "", "MySQL", "", "", "", "", "", "", "vCPU-Hours", "RDS Extended Support Year 1-2 for MySQL 5.7", "", "", "", "", "", "", "AWS"),
    (32, "AmazonRDS", "AmazonRDS", "Database Instance", "InstanceUsage:db.m5.large", "CreateDBInstance:0002", "arn:aws:rds:{r}:{a}:db:mysql-app-", "db.m5.large", "MySQL", "", "Intel Xeon Platinum 8175", "", "x86_64", "2", "8 GiB", "Hrs", "$0.171 per RDS db.m5.large instance hour running MySQL", "", "", "", "4", "No license required", "", "AWS"),
    (33, "AWSLambda", "AWSLambda", "Serverless", "Lambda-GB-Second", "Invoke", "arn:aws:lambda:{r}:{a}:function:api-handler-", "", "", "", "", "", "", "", "", "Lambda-GB-Second", "AWS Lambda - Total Compute", "", "", "", "", "", "", "AWS"),
    (34, "AWSLambda", "AWSLambda", "Serverless", "Lambda-GB-Second-ARM", "Invoke", "arn:aws:lambda:{r}:{a}:function:worker-", "", "", "", "", "", "", "", "", "Lambda-GB-Second", "AWS Lambda - Total Compute ARM", "", "", "", "", "", "", "AWS"),
    (35, "AWSLambda", "AWSLambda", "Serverless", "Request", "Invoke", "arn:aws:lambda:{r}:{a}:function:api-handler-", "", "", "", "", "", "", "", "", "Requests", "AWS Lambda - Total Requests", "", "", "", "", "", "", "AWS"),
    (36, "AmazonDynamoDB", "AmazonDynamoDB", "Database Storage", "TimedStorage-ByteHrs", "StandardStorage", "arn:aws:dynamodb:{r}:{a}:table/orders-", "", "", "", "", "", "", "", "", "GB-Mo", "$0.25 per GB-Month of storage used beyond first 25 free GB-Months", "", "", "", "", "", "", "AWS"),
    (37, "AmazonDynamoDB", "AmazonDynamoDB", "Amazon DynamoDB PayPerRequest Throughput", "ReadRequestUnits", "PayPerRequestThroughput", "arn:aws:dynamodb:{r}:{a}:table/orders-", "", "", "", "", "", "", "", "", "ReadRequestUnits", "$0.25 per million read request units", "", "", "", "", "", "", "AWS"),
    (38, "AmazonDynamoDB", "AmazonDynamoDB", "Provisioned IOPS", "WriteCapacityUnit-Hrs", "CommittedThroughput", "arn:aws:dynamodb:{r}:{a}:table/events-", "", "", "", "", "", "", "", "", "WriteCapacityUnit-Hrs", "$0.00065 per WriteCapacityUnit-Hour", "", "", "", "", "", "", "AWS"),
    (39, "AmazonElastiCache", "AmazonElastiCache", "Cache Instance", "NodeUsage:cache.r6g.large", "CreateCacheCluster:0002", "arn:aws:elasticache:{r}:{a}:cluster:redis-prod-00", "cache.r6g.large", "", "Redis", "AWS Graviton2", "", "arm64", "2", "13.07 GiB", "Hrs", "$0.206 per Cache Node Hour running Redis", "", "", "", "4", "", "", "AWS"),
    (40, "AmazonCloudWatch", "AmazonCloudWatch", "Storage Snapshot", "TimedStorage-ByteHrs", "HourlyStorageMetering", "arn:aws:logs:{r}:{a}:log-group:/aws/lambda/api-", "", "", "", "", "", "", "", "", "GB-Mo", "$0.03 per GB-mo of log storage", "", "", "", "", "", "", "AWS"),
    (41, "AmazonCloudWatch", "AmazonCloudWatch", "Data Payload", "DataProcessing-Bytes", "PutLogEvents", "arn:aws:logs:{r}:{a}:log-group:/aws/lambda/api-", "", "", "", "", "", "", "", "", "GB", "$0.50 per GB custom log data ingested", "", "", "", "", "", "", "AWS"),
    (42, "AWSConfig", "AWSConfig", "Management Tools - AWS Config", "ConfigurationItemRecorded", "None", "", "", "", "", "", "", "", "", "", "ConfigurationItemRecorded", "$0.003 per Configuration Item recorded", "", "", "", "", "", "", "AWS"),
    (43, "AmazonApiGateway", "AmazonApiGateway", "API Calls", "ApiGatewayRequest", "ApiGatewayRequest", "arn:aws:apigateway:{r}::/restapis/api", "", "", "", "", "", "", "", "", "Requests", "$3.50/million requests - API Gateway REST API", "", "", "", "", "", "", "AWS"),
    (44, "AmazonKinesis", "AmazonKinesis", "Kinesis Streams", "Storage-ShardHour", "shardHourStorage", "arn:aws:kinesis:{r}:{a}:stream/clicks-", "", "", "", "", "", "", "", "", "ShardHour", "$0.015 per provisioned shard hour", "", "", "", "", "", "", "AWS"),
    (45, "AWSELB", "AWSELB", "Load Balancer-Application", "LoadBalancerUsage", "LoadBalancing:Application", "arn:aws:elasticloadbalancing:{r}:{a}:loadbalancer/app/web-", "", "", "", "", "", "", "", "", "Hrs", "$0.0225 per Application LoadBalancer-hour", "", "", "", "", "", "", "AWS"),
    (46, "AWSELB", "AWSELB", "Load Balancer-Application", "LCUUsage", "LoadBalancing:Application", "arn:aws:elasticloadbalancing:{r}:{a}:loadbalancer/app/web-", "", "", "", "", "", "", "", "", "LCU-Hrs", "$0.008 per used Application load balancer capacity unit-hour", "", "", "", "", "", "", "AWS"),
    (47, "AWSNetworkFirewall", "AWSNetworkFirewall", "Firewall", "Endpoint-Hour", "VpcEndpoint", "arn:aws:network-firewall:{r}:{a}:firewall/edge-", "", "", "", "", "", "", "", "", "Hrs", "$0.395 per firewall endpoint hour", "", "", "", "", "", "", "AWS"),
    (48, "AWSNetworkFirewall", "AWSNetworkFirewall", "Firewall", "Traffic-GB-Processed", "VpcEndpoint", "arn:aws:network-firewall:{r}:{a}:firewall/edge-", "", "", "", "", "", "", "", "", "GB", "$0.065 per GB processed by firewall endpoints", "", "", "", "", "", "", "AWS"),
    (49, "AmazonWorkSpaces", "AmazonWorkSpaces", "Virtual Desktop", "AW-HW-2-AutoStop-Usage", "Windows:BYOL", "arn:aws:workspaces:{r}:{a}:workspace/ws-", "", "", "", "", "Windows", "", "2", "4 GiB", "Hrs", "Performance AutoStop hourly usage Windows BYOL", "", "", "", "", "Bring your own license", "", "AWS"),
    (50, "AmazonECS", "AmazonECS", "Compute", "Fargate-vCPU-Hours:perCPU", "FargateTask", "arn:aws:ecs:{r}:{a}:cluster/prod-cluster-", "", "", "", "", "", "", "", "", "hours", "AWS Fargate - vCPU - US East", "", "", "", "", "", "", "AWS"),
    (51, "AmazonECS", "AmazonECS", "Compute", "Fargate-GB-Hours", "FargateTask", "arn:aws:ecs:{r}:{a}:service/prod-cluster/web-", "", "", "", "", "", "", "", "", "hours", "AWS Fargate - Memory - US East", "", "", "", "", "", "", "AWS"),
    (52, "AWSSupportEnterprise", "AWSSupportEnterprise", "Support", "Dollar", "", "", "", "", "", "", "", "", "", "", "Dollar", "AWS Support (Enterprise)", "", "", "", "", "", "", "AWS"),
    (53, "prodmkt7x2", "prodmkt7x2", "SaaS", "SoftwareUsage:firewall", "Unit", "", "", "", "", "", "", "", "", "", "Units", "Acme Firewall subscription", "", "", "Acme Firewall", "", "", "", "AWS Marketplace"),
    (54, "AWSNewService", "AWSNewService", "Misc", "NewService-Requests", "Invoke", "", "", "", "", "", "", "", "", "", "Requests", "New service usage", "", "", "", "", "", "", "AWS"),
    (55, "AmazonEKS", "AmazonEKS", "Compute", "AmazonEKS-Hours:perCluster", "CreateOperation", "arn:aws:eks:{r}:{a}:cluster/prod-", "", "", "", "", "", "", "", "", "Hours", "Amazon EKS cluster usage", "", "", "", "", "", "", "AWS"),
    (56, "AmazonEKS", "AmazonEKS", "Compute", "AmazonEKS-Hours:extendedSupport", "CreateOperation", "arn:aws:eks:{r}:{a}:cluster/legacy-", "", "", "", "", "", "", "", "", "Hours", "Amazon EKS extended support", "", "", "", "", "", "", "AWS"),
    (58, "AmazonEC2", "AmazonEC2", "Compute", "EKS-EC2-vCPU-Hours", "EKSPod-EC2", "arn:aws:eks:{r}:{a}:cluster/prod-", "", "", "", "", "", "", "", "", "vCPU-Hours", "EKS pod split cost allocation (vCPU)", "", "", "", "", "", "", "AWS"),
    (59, "AmazonSNS", "AmazonSNS", "Message Delivery", "DeliveryAttempts-HTTP", "Notification", "arn:aws:sns:{r}:{a}:alerts-", "", "", "", "", "", "", "", "", "Notifications", "SNS HTTP deliveries", "", "", "", "", "", "", "AWS"),
    (60, "AWSQueueService", "AWSQueueService", "API Request", "Requests-Tier1", "GetQueueAttributes", "arn:aws:sqs:{r}:{a}:jobs-", "", "", "", "", "", "", "", "", "Requests", "SQS standard requests", "", "", "", "", "", "", "AWS"),
    (61, "AmazonSageMaker", "AmazonSageMaker", "ML Instance", "Host:ml.m5.large", "RunInstance", "arn:aws:sagemaker:{r}:{a}:endpoint/model-", "ml.m5.large", "", "", "", "", "", "2", "8 GiB", "Hrs", "SageMaker hosting ml.m5.large", "", "", "", "", "", "", "AWS"),
    (62, "AmazonBedrock", "AmazonBedrock", "Machine Learning", "TitanText-input-tokens", "InvokeModel", "", "", "", "", "", "", "", "", "", "1K tokens", "Bedrock text input tokens", "", "", "", "", "", "", "AWS"),
    (63, "AmazonGuardDuty", "AmazonGuardDuty", "Security Services", "PaidEventsAnalyzed", "None", "", "", "", "", "", "", "", "", "", "Events", "GuardDuty CloudTrail events analyzed", "", "", "", "", "", "", "AWS"),
    (64, "awskms", "awskms", "Encryption Key", "KMS-Requests", "Decrypt", "arn:aws:kms:{r}:{a}:key/k-", "", "", "", "", "", "", "", "", "Requests", "KMS requests", "", "", "", "", "", "", "AWS"),
    (65, "AWSSecretsManager", "AWSSecretsManager", "Secret", "AWSSecretsManager-Secrets", "StoreSecret", "arn:aws:secretsmanager:{r}:{a}:secret:db-", "", "", "", "", "", "", "", "", "Secrets", "Secrets stored", "", "", "", "", "", "", "AWS"),
    (66, "AWSCloudTrail", "AWSCloudTrail", "Management Tools - AWS CloudTrail Data Events Recorded", "DataEventsRecorded", "None", "", "", "", "", "", "", "", "", "", "Events", "CloudTrail data events", "", "", "", "", "", "", "AWS"),
    (67, "AmazonEFS", "AmazonEFS", "Storage", "TimedStorage-ByteHrs", "Storage", "arn:aws:elasticfilesystem:{r}:{a}:file-system/fs-", "", "", "", "", "", "", "", "", "GB-Mo", "EFS standard storage", "", "", "", "", "", "", "AWS"),
    (68, "AmazonRoute53", "AmazonRoute53", "DNS Query", "DNS-Queries", "Query", "arn:aws:route53:::hostedzone/Z", "", "", "", "", "", "", "", "", "Queries", "Route 53 standard queries", "", "", "", "", "", "", "AWS"),
    (69, "AmazonCloudFront", "AmazonCloudFront", "Data Transfer", "DataTransfer-Out-Bytes", "GET", "arn:aws:cloudfront::{a}:distribution/E", "", "", "", "", "", "", "", "", "GB", "CloudFront data transfer out", "", "", "", "", "", "", "AWS"),
    (70, "AWSGlue", "AWSGlue", "AWS Glue", "ETL-DPU-Hour", "Jobrun", "arn:aws:glue:{r}:{a}:job/etl-", "", "", "", "", "", "", "", "", "DPU-Hour", "Glue ETL job DPU hours", "", "", "", "", "", "", "AWS"),
    (71, "AmazonAthena", "AmazonAthena", "Serverless", "DataScannedInTB", "RunQuery", "arn:aws:athena:{r}:{a}:workgroup/primary", "", "", "", "", "", "", "", "", "Terabytes", "Athena data scanned", "", "", "", "", "", "", "AWS"),
    (57, "AmazonRDS", "AmazonRDS", "Database Instance", "ExtendedSupport:Yr3:PostgreSQL11", "CreateDBInstance:0014", "arn:aws:rds:{r}:{a}:db:pg-legacy-", "", "PostgreSQL", "", "", "", "", "", "", "vCPU-Hours", "RDS Extended Support Year 3 for PostgreSQL 11", "", "", "", "", "", "", "AWS"),
]

TEMPLATE_COLS = [
    "tid", "pc", "ssc", "fam", "ut", "op", "res", "itype", "dbeng", "cacheeng", "proc", "os", "arch",
    "vcpu", "mem", "unit", "descr", "volapi", "att", "pname", "nf", "lic", "tenancy", "entity",
]

# region slot: (ridx, product region, usage type prefix, location name)
REGION_SLOTS = [
    (0, "us-east-1", "", "US East (N. Virginia)"),
    (1, "us-west-2", "USW2-", "US West (Oregon)"),
    (2, "eu-west-1", "EU-", "EU (Ireland)"),
    (3, "ap-southeast-1", "APS1-", "Asia Pacific (Singapore)"),
    (4, "eu-central-1", "EUC1-", "EU (Frankfurt)"),
    (5, "", "USE2-", "US East (Ohio)"),
]

TABLES = ("lineitem", "orders", "customer", "part")


def _values(rows, cols) -> str:
    def q(v):
        if isinstance(v, int):
            return str(v)
        return "'" + str(v).replace("'", "''") + "'"

    body = ",\n    ".join("(" + ", ".join(q(v) for v in r) + ")" for r in rows)
    return f"(VALUES\n    {body}\n) AS t({', '.join(cols)})"


def cur_source_sql(names: dict[str, str] | None = None, narrow_first: bool = False) -> str:
    """Portable (Spark + DuckDB) SQL producing the billing-export-shaped rows. ``names`` maps the
    driver table names to the relation names to read (default: the names themselves). ``narrow_first``
    (Spark only): the same joins with the narrow sides first, so that line items are shuffled twice at most, and
    never with the strings of their order."""
    names = names or {}
    lineitem, orders, customer, part = (names.get(t, t) for t in ("lineitem", "orders", "customer", "part"))
    n = len(TEMPLATES)
    tpl = _values(TEMPLATES, TEMPLATE_COLS)
    reg = _values(REGION_SLOTS, ["ridx", "reg", "pfx", "locname"])
    price = "CAST(s.l_extendedprice AS DECIMAL(18,2))"
    disc = "CAST(s.l_discount AS DECIMAL(4,2))"
    sp = "s.ct IN ('SavingsPlanCoveredUsage', 'SavingsPlanRecurringFee', 'SavingsPlanNegation', 'SavingsPlanUpfrontFee')"
    ri = "(s.ct IN ('DiscountedUsage', 'RIFee') OR (s.ct = 'Fee' AND s.l_orderkey % 2 = 0))"
    acct = "lpad(CAST(s.o_custkey % 24 + 1 AS STRING), 12, '0')"
    payer = "lpad(CAST(s.o_custkey % 3 + 901 AS STRING), 12, '0')"
    unblended = f"{price} * (1 - {disc})"
    sign = "CASE WHEN s.ct IN ('Credit', 'Refund', 'EdpDiscount', 'SavingsPlanNegation') THEN -1 ELSE 1 END"
    is_instance = "t.nf <> ''"
    retail, joined = "p.p_retailprice", f"""{lineitem} l
  JOIN {orders} o ON l.l_orderkey = o.o_orderkey
  JOIN {customer} c ON o.o_custkey = c.c_custkey
  JOIN {part} p ON l.l_partkey = p.p_partkey"""
    if narrow_first:
        retail, joined = "l.p_retailprice", f"""(
    SELECT /*+ REPARTITION(l_orderkey) */ l.*, p.p_retailprice
    FROM {lineitem} l JOIN {part} p ON l.l_partkey = p.p_partkey) l
  JOIN ({orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey) ON l.l_orderkey = o.o_orderkey"""
    return f"""
SELECT
  s.l_shipdate AS line_item_usage_start_date,
  date_trunc('month', s.l_shipdate) AS bill_billing_period_start_date,
  date_trunc('month', s.l_shipdate) + INTERVAL 1 MONTH AS bill_billing_period_end_date,
  {acct} AS line_item_usage_account_id,
  CASE WHEN s.o_custkey % 24 = 23 THEN NULL ELSE 'account-' || lpad(CAST(s.o_custkey % 24 + 1 AS STRING), 2, '0') END AS line_item_usage_account_name,
  {payer} AS bill_payer_account_id,
  'payer-' || CAST(s.o_custkey % 3 + 1 AS STRING) AS bill_payer_account_name,
  t.entity AS bill_billing_entity,
  'Anniversary' AS bill_bill_type,
  'Amazon Web Services, Inc.' AS bill_invoicing_entity,
  CASE WHEN s.o_custkey % 3 = 2 THEN '' ELSE 'INV-' || CAST(s.o_custkey % 3 + 901 AS STRING) || '-' || replace(substr(CAST(s.l_shipdate AS STRING), 1, 7), '-', '') END AS bill_invoice_id,
  CASE WHEN t.entity = 'AWS Marketplace' THEN 'Acme Software LLC' ELSE 'Amazon Web Services, Inc.' END AS line_item_legal_entity,
  t.fam AS product_product_family,
  t.pc AS line_item_product_code,
  t.pname AS product_product_name,
  t.ssc AS product_servicecode,
  CASE WHEN t.pc = 'AWSELB' THEN 'ELB:Balancer' WHEN t.fam = 'Transit Gateway' THEN 'AWSTransitGateway' ELSE '' END AS product_group,
  s.ct AS line_item_line_item_type,
  CASE WHEN s.ct = 'Tax' THEN '' ELSE r.pfx || t.ut END AS line_item_usage_type,
  t.op AS line_item_operation,
  t.descr AS line_item_line_item_description,
  CASE WHEN r.reg = '' THEN '' ELSE r.reg || 'a' END AS line_item_availability_zone,
  CASE WHEN t.pc = 'AWSSupportEnterprise' THEN '' ELSE r.reg END AS product_region,
  CASE WHEN t.pc = 'AWSSupportEnterprise' THEN ''
       WHEN r.ridx = 5 OR t.fam = 'Data Transfer' THEN r.locname ELSE '' END AS product_from_location,
  CASE WHEN t.fam = 'Data Transfer' THEN 'External' ELSE '' END AS product_to_location,
  t.att AS product_attachment_type,
  CASE WHEN t.res = '' THEN ''
       WHEN s.l_partkey % 29 = 0 THEN NULL
       ELSE replace(replace(t.res, '{{r}}', CASE WHEN r.reg = '' THEN 'us-east-2' ELSE r.reg END), '{{a}}', {acct})
            || CAST(s.l_partkey % 40 AS STRING) END AS line_item_resource_id,
  t.itype AS product_instance_type,
  t.os AS product_operating_system,
  t.tenancy AS product_tenancy,
  t.proc AS product_physical_processor,
  CASE WHEN t.proc = '' THEN '' WHEN t.proc LIKE 'Intel%' THEN 'Intel AVX; Intel AVX2; Intel Turbo' ELSE 'N/A' END AS product_processor_features,
  CASE WHEN t.arch = 'arm64' THEN '64-bit' WHEN t.arch = 'x86_64' THEN '64-bit' ELSE '' END AS product_processor_architecture,
  t.dbeng AS product_database_engine,
  t.cacheeng AS product_cache_engine,
  CASE WHEN t.pc = 'AmazonRDS' THEN 'Single-AZ' ELSE '' END AS product_deployment_option,
  CASE WHEN t.pc = 'AmazonRDS' AND t.fam = 'Database Storage' THEN 'EBS Only' ELSE '' END AS product_storage,
  CASE WHEN t.volapi = '' THEN '' ELSE 'General Purpose' END AS product_volume_type,
  t.volapi AS product_volume_api_name,
  t.lic AS product_license_model,
  t.vcpu AS product_vcpu,
  CASE WHEN t.mem = '' THEN 'NA' ELSE t.mem END AS product_memory,
  CASE WHEN s.o_custkey % 5 = 0 THEN '' ELSE lower(s.c_mktsegment) END AS resource_tags_user_team,
  CASE WHEN s.l_orderkey % 4 = 0 THEN '' ELSE lower(substr(s.o_orderpriority, 3)) END AS resource_tags_user_env,
  CASE WHEN s.l_suppkey % 3 = 0 THEN NULL ELSE 'cc-' || CAST(s.c_nationkey % 4 AS STRING) END AS resource_tags_user_cost_center,
  CASE WHEN {ri} THEN 'No Upfront' ELSE '' END AS pricing_purchase_option,
  CASE WHEN {ri} THEN 'standard' ELSE '' END AS pricing_offering_class,
  CASE WHEN {ri} THEN (CASE WHEN s.o_custkey % 2 = 0 THEN '1yr' ELSE '3yr' END) ELSE '' END AS pricing_lease_contract_length,
  t.unit AS pricing_unit,
  CASE WHEN s.ct = 'Usage' AND t.ut LIKE 'SpotUsage%' THEN ''
       WHEN s.ct = 'Usage' THEN 'OnDemand'
       WHEN {ri} THEN 'Reserved' ELSE '' END AS pricing_term,
  CASE WHEN {sp} THEN 'arn:aws:savingsplans::' || {payer} || ':savingsplan/sp-' || CAST(s.o_custkey % 5 AS STRING) ELSE '' END AS savings_plan_savings_plan_a_r_n,
  CAST(CASE WHEN s.ct = 'SavingsPlanCoveredUsage' THEN (CASE WHEN s.l_orderkey % 37 = 0 THEN 0 ELSE {price} * 0.72 END) END AS DECIMAL(18,4)) AS savings_plan_savings_plan_effective_cost,
  CAST(CASE WHEN s.ct = 'SavingsPlanCoveredUsage' THEN CAST(s.p_retailprice AS DECIMAL(18,2)) * 0.00072 END AS DECIMAL(18,8)) AS savings_plan_savings_plan_rate,
  CAST(CASE WHEN s.ct = 'SavingsPlanRecurringFee' THEN {price} * 0.5 END AS DECIMAL(18,4)) AS savings_plan_recurring_commitment_for_billing_period,
  CAST(CASE WHEN s.ct = 'SavingsPlanRecurringFee' THEN {price} * 0.25 END AS DECIMAL(18,4)) AS savings_plan_amortized_upfront_commitment_for_billing_period,
  CASE WHEN {sp} THEN (CASE WHEN s.o_custkey % 2 = 0 THEN 'ComputeSavingsPlans' ELSE 'EC2InstanceSavingsPlans' END) ELSE '' END AS savings_plan_offering_type,
  CASE WHEN {sp} THEN (CASE WHEN s.o_custkey % 3 = 0 THEN 'All Upfront' ELSE 'No Upfront' END) ELSE '' END AS savings_plan_payment_option,
  CASE WHEN {sp} THEN (CASE WHEN s.o_custkey % 2 = 0 THEN '1yr' ELSE '3yr' END) ELSE '' END AS savings_plan_purchase_term,
  CASE WHEN {sp} THEN '2000-01-01T00:00:00.000Z' ELSE '' END AS savings_plan_start_time,
  CASE WHEN {sp} THEN '2003-01-01T00:00:00.000Z' ELSE '' END AS savings_plan_end_time,
  CAST(CASE WHEN s.ct = 'SavingsPlanCoveredUsage' AND s.l_orderkey % 6 <> 0 THEN {price} * 0.70 END AS DECIMAL(18,4)) AS savings_plan_net_savings_plan_effective_cost,
  CAST(CASE WHEN s.ct = 'SavingsPlanRecurringFee' THEN {price} * 0.24 END AS DECIMAL(18,4)) AS savings_plan_net_amortized_upfront_commitment_for_billing_period,
  CAST(CASE WHEN s.ct = 'SavingsPlanRecurringFee' THEN {price} * 0.48 END AS DECIMAL(18,4)) AS savings_plan_net_recurring_commitment_for_billing_period,
  CASE WHEN {ri} THEN 'arn:aws:ec2:us-east-1:' || {payer} || ':reserved-instances/ri-' || CAST(s.l_partkey % 7 AS STRING) ELSE '' END AS reservation_reservation_a_r_n,
  CAST(CASE WHEN s.ct = 'DiscountedUsage' THEN (CASE WHEN s.l_orderkey % 37 = 0 THEN 0 ELSE {price} * 0.6 END) END AS DECIMAL(18,4)) AS reservation_effective_cost,
  CAST(CASE WHEN s.ct = 'RIFee' THEN {price} * 0.05 END AS DECIMAL(18,4)) AS reservation_unused_amortized_upfront_fee_for_billing_period,
  CAST(CASE WHEN s.ct = 'RIFee' THEN {price} * 0.3 END AS DECIMAL(18,4)) AS reservation_amortized_upfront_fee_for_billing_period,
  CASE WHEN {ri} AND s.l_suppkey % 9 <> 0 THEN '2000-06-01T00:00:00Z' ELSE '' END AS reservation_start_time,
  CASE WHEN {ri} AND s.l_suppkey % 9 <> 0 THEN '2003-06-01T00:00:00Z' ELSE '' END AS reservation_end_time,
  CAST(CASE WHEN s.ct = 'DiscountedUsage' AND s.l_orderkey % 6 <> 0 THEN {price} * 0.58 END AS DECIMAL(18,4)) AS reservation_net_effective_cost,
  'li-' || CAST(s.l_orderkey AS STRING) || '-' || CAST(s.l_linenumber AS STRING) AS identity_line_item_id,
  CASE WHEN s.ct = 'Tax' THEN '' ELSE 'SKU' || CAST(s.l_partkey % 97 AS STRING) END AS product_sku,
  CASE WHEN {is_instance} THEN t.nf ELSE '' END AS line_item_normalization_factor,
  CAST(CASE WHEN {is_instance} THEN CAST(s.l_quantity AS DECIMAL(18,2)) * CAST(t.nf AS DECIMAL(8,2)) END AS DECIMAL(18,4)) AS line_item_normalized_usage_amount,
  CAST(CASE WHEN s.l_partkey % 41 = 0 THEN 0 ELSE CAST(s.l_quantity AS DECIMAL(18,2)) END AS DECIMAL(18,4)) AS line_item_usage_amount,
  CAST({sign} * {unblended} AS DECIMAL(18,4)) AS line_item_unblended_cost,
  CAST(CASE WHEN s.l_partkey % 13 = 0 THEN NULL ELSE CAST(s.p_retailprice AS DECIMAL(18,2)) * 0.001 END AS DECIMAL(18,6)) AS line_item_unblended_rate,
  CAST(CASE WHEN s.l_orderkey % 4 = 0 THEN NULL ELSE {sign} * {price} * (1 - {disc} - 0.01) END AS DECIMAL(18,4)) AS line_item_net_unblended_cost,
  CAST(CASE WHEN s.l_orderkey % 4 = 0 OR s.l_partkey % 13 = 0 THEN NULL ELSE CAST(s.p_retailprice AS DECIMAL(18,2)) * 0.00099 END AS DECIMAL(18,8)) AS line_item_net_unblended_rate,
  CAST({price} AS DECIMAL(18,4)) AS pricing_public_on_demand_cost,
  CAST(CAST(s.p_retailprice AS DECIMAL(18,2)) * 0.0012 AS DECIMAL(18,6)) AS pricing_public_on_demand_rate,
  CAST(CASE WHEN s.l_suppkey % 11 = 0 THEN {price} * 0.02 END AS DECIMAL(18,4)) AS discount_bundled_discount,
  substr(CAST(s.l_shipdate AS STRING), 1, 7) AS billing_period
FROM (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity, l.l_extendedprice,
         l.l_discount, l.l_returnflag, l.l_shipdate,
         o.o_custkey, o.o_orderpriority, c.c_nationkey, c.c_mktsegment, {retail},
         CAST((l.l_partkey * 7 + l.l_suppkey) % {n} AS INT) AS tid,
         CAST(c.c_nationkey % 6 AS INT) AS ridx,
         CASE
           WHEN l.l_linenumber <= 3 THEN 'Usage'
           WHEN l.l_linenumber = 4 THEN 'SavingsPlanCoveredUsage'
           WHEN l.l_linenumber = 5 THEN 'DiscountedUsage'
           WHEN l.l_linenumber = 6 THEN
             CASE WHEN l.l_returnflag = 'R' THEN 'Credit'
                  WHEN l.l_returnflag = 'A' THEN 'Tax'
                  WHEN l.l_orderkey % 5 = 0 THEN 'EdpDiscount'
                  WHEN l.l_orderkey % 7 = 0 THEN 'SppDiscount'
                  ELSE 'Fee' END
           ELSE
             CASE WHEN l.l_returnflag = 'R' THEN 'Refund'
                  WHEN l.l_returnflag = 'A' THEN
                    (CASE WHEN l.l_orderkey % 2 = 0 THEN 'SavingsPlanRecurringFee' ELSE 'SavingsPlanNegation' END)
                  WHEN l.l_orderkey % 3 = 0 THEN 'SavingsPlanUpfrontFee'
                  ELSE 'RIFee' END
         END AS ct
  FROM {joined}
) s
JOIN {tpl} ON s.tid = t.tid
JOIN {reg.replace('AS t(', 'AS r(')} ON s.ridx = r.ridx
"""


# the driver tables are single-row-group files (one scan task each); spread the fact tables over the
# cluster's cores by a hash of their key so the shaping projection and everything after it run in parallel.
# No number of tasks is given: adaptive execution takes it from the size, so a larger table has more tasks, not
# larger ones. Line items are spread by ``cur_source_sql``, after their join with ``part``
FACT_KEYS = {"events": "event_id"}


def register_driver_tables(spark: SparkSession, sf_dir: str, tables=TABLES) -> dict[str, str]:
    """Temp views over the driver tables of ``sf_dir``; names are unique per directory so queries on
    different scale factors can run side by side in one session. Returns table -> view name."""
    import hashlib

    tag = hashlib.sha1(sf_dir.encode()).hexdigest()[:10]
    names = {}
    for name in tables:
        df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        if name in FACT_KEYS:
            df = df.repartition(FACT_KEYS[name])
        names[name] = f"costlake_{tag}_{name}"
        df.createOrReplaceTempView(names[name])
    return names


def cur_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw billing-export-shaped DataFrame over the driver tables in ``sf_dir``."""
    return spark.sql(cur_source_sql(register_driver_tables(spark, sf_dir), narrow_first=True))


def events_billing_sql(events: str = "events") -> str:
    """Hourly billing lines shaped from ``events`` (sub-second timestamps of one month): timestamp ->
    usage date, value -> cost, user -> payer account, event type -> charge type."""
    return """
SELECT e.ts AS usage_date,
  lpad(CAST(e.user_id % 7 + 901 AS STRING), 12, '0') AS payer_account_id,
  CASE e.event_type WHEN 'purchase' THEN 'Usage' WHEN 'click' THEN 'Usage' WHEN 'view' THEN 'DiscountedUsage'
       WHEN 'signup' THEN 'Fee' ELSE 'Tax' END AS charge_type,
  CAST(CAST(e.value AS DECIMAL(18,2)) AS DECIMAL(18,4)) AS unblended_cost
FROM {events} e
""".replace("{events}", events)


def events_billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    names = register_driver_tables(spark, sf_dir, tables=("events",))
    return spark.sql(events_billing_sql(names["events"])).withColumn("usage_date", F.col("usage_date").cast("timestamp"))
