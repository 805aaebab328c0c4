"""Reference dimensions ("seeds"): regions, product -> service name/category, instance modernization.

Seeds are small, fixed-size dimension tables (tens to a few hundred rows), so they are built on the
driver; their size does not grow with the billing data. ``load_seed`` also reads a
user-supplied CSV from shared storage when a path is given (``spark.read.csv`` with a fixed schema).
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------------
# Public AWS region codes and their console names (region_id, region_name,
# region_country, region_city, region_latitude, region_longitude, region_timezone). 'global' is the bucket
# for non-regional usage, 'external' for places that are no region.
# ---------------------------------------------------------------------------------------------
REGIONS = [
    ("global", "Global", "Global", "Global", 0.00, 0.00, "UTC"),
    ("af-south-1", "Africa (Cape Town)", "South Africa", "Cape Town", -33.91, 18.42, "Africa/Johannesburg"),
    ("ap-east-1", "Asia Pacific (Hong Kong)", "Hong Kong", "Hong Kong", 22.28, 114.15, "Asia/Hong_Kong"),
    ("ap-east-2", "Asia Pacific (Taiwan)", "Taiwan", "Taipei", 25.03, 121.56, "Asia/Taipei"),
    ("ap-northeast-1", "Asia Pacific (Tokyo)", "Japan", "Tokyo", 35.64, 139.76, "Asia/Tokyo"),
    ("ap-northeast-2", "Asia Pacific (Seoul)", "South Korea", "Seoul", 37.72, 126.04, "Asia/Seoul"),
    ("ap-northeast-3", "Asia Pacific (Osaka)", "Japan", "Osaka", 34.69, 135.5, "Asia/Tokyo"),
    ("ap-south-1", "Asia Pacific (Mumbai)", "India", "Mumbai", 19.08, 72.88, "Asia/Kolkata"),
    ("ap-south-2", "Asia Pacific (Hyderabad)", "India", "Hyderabad", 17.39, 78.49, "Asia/Kolkata"),
    ("ap-southeast-1", "Asia Pacific (Singapore)", "Singapore", "Singapore", 1.35, 103.86, "Asia/Singapore"),
    ("ap-southeast-2", "Asia Pacific (Sydney)", "Australia", "Sydney", -33.88, 151.23, "Australia/Sydney"),
    ("ap-southeast-3", "Asia Pacific (Jakarta)", "Indonesia", "Jakarta", -6.17, 106.82, "Asia/Jakarta"),
    ("ap-southeast-4", "Asia Pacific (Melbourne)", "Australia", "Melbourne", -37.81, 144.96, "Australia/Melbourne"),
    ("ap-southeast-5", "Asia Pacific (Malaysia)", "Malaysia", "Kuala Lumpur", 3.14, 101.69, "Asia/Kuala_Lumpur"),
    ("ap-southeast-7", "Asia Pacific (Thailand)", "Thailand", "Bangkok", 13.76, 100.50, "Asia/Bangkok"),
    ("ca-central-1", "Canada (Central)", "Canada", "Montreal", 45.50, -73.57, "America/Toronto"),
    ("ca-west-1", "Canada West (Calgary)", "Canada", "Calgary", 51.05, -114.07, "America/Edmonton"),
    ("cn-north-1", "China (Beijing)", "China", "Beijing", 39.91, 116.41, "Asia/Beijing"),
    ("cn-northwest-1", "China (Ningxia)", "China", "Ningxia", 38.47, 106.26, "Asia/Beijing"),
    ("eu-central-1", "EU (Frankfurt)", "Germany", "Frankfurt", 50.11, 8.68, "Europe/Berlin"),
    ("eu-central-2", "EU (Zurich)", "Switzerland", "Zurich", 47.37, 8.54, "Europe/Zurich"),
    ("eu-north-1", "EU (Stockholm)", "Sweden", "Stockholm", 59.33, 18.07, "Europe/Stockholm"),
    ("eu-south-1", "EU (Milan)", "Italy", "Milan", 45.46, 9.18, "Europe/Rome"),
    ("eu-south-2", "EU (Spain)", "Spain", "Madrid", 40.41, -3.70, "Europe/Madrid"),
    ("eu-west-1", "EU (Ireland)", "Ireland", "Dublin", 53.35, -6.26, "Europe/Dublin"),
    ("eu-west-2", "EU (London)", "United Kingdom", "London", 51.51, -0.13, "Europe/London"),
    ("eu-west-3", "EU (Paris)", "France", "Paris", 48.85, 2.35, "Europe/Paris"),
    ("il-central-1", "Israel (Tel Aviv)", "Israel", "Tel Aviv", 32.08, 34.78, "Asia/Jerusalem"),
    ("me-central-1", "Middle East (UAE)", "United Arab Emirates", "Dubai", 25.27, 55.29, "Asia/Dubai"),
    ("me-south-1", "Middle East (Bahrain)", "Bahrain", "Bahrain", 26.11, 50.50, "Asia/Bahrain"),
    ("mx-central-1", "Mexico (Central)", "Mexico", "Mexico City", 19.43, -99.13, "America/Mexico_City"),
    ("sa-east-1", "South America (Sao Paulo)", "Brazil", "Sao Paulo", -23.37, -46.63, "America/Sao_Paulo"),
    ("us-east-1", "US East (N. Virginia)", "United States", "Virginia", 38.80, -77.11, "America/New_York"),
    ("us-east-2", "US East (Ohio)", "United States", "Ohio", 40.36, -82.91, "America/New_York"),
    ("us-gov-east-1", "AWS GovCloud (US-East)", "United States", "Ohio", 40.49, -81.45, "America/New_York"),
    ("us-gov-west-1", "AWS GovCloud (US-West)", "United States", "Oregon", 39.53, -119.88, "America/Los_Angeles"),
    ("us-west-1", "US West (N. California)", "United States", "California", 36.55, -119.89, "America/Los_Angeles"),
    ("us-west-2", "US West (Oregon)", "United States", "Oregon", 43.82, -120.33, "America/Los_Angeles"),
    ("external", "External", "Global", "External", 0.00, 0.00, "UTC"),
]

# ---------------------------------------------------------------------------------------------
# Public AWS product codes -> (service display name, service category), for infrastructure, data,
# developer and management services. Codes of other categories (business and customer applications, media, IoT, games
# and the like) are given by a full table as a CSV: CostModels(seed_paths={"products": ...}).
# ---------------------------------------------------------------------------------------------
PRODUCTS = [
    ("ACM", "AWS Certificate Manager", "Security, Identity and Compliance"),
    ("AWSAmplify", "AWS Amplify", "Front-end Web and Mobile"),
    ("AWSAppFabric", "AWS AppFabric", "Integration"),
    ("AWSAppRunner", "AWS App Runner", "Compute"),
    ("AWSAppStudio", "AWS App Studio", "AI and Machine Learning"),
    ("AWSAppSync", "AWS AppSync", "Front-end Web and Mobile"),
    ("AWSApplicationMigrationSvc", "AWS Application Migration Service", "Migration and Transfer"),
    ("AWSB2Bi", "AWS B2B Data Interchange", "Integration"),
    ("AWSBCMPricingCalculator", "AWS Billing and Cost Management Pricing Calculator", "Cost Management"),
    ("AWSBackup", "AWS Backup", "Storage"),
    ("AWSBillingConductor", "AWS Billing Conductor", "Cost Management"),
    ("AWSBudgets", "AWS Budgets", "Cost Management"),
    ("AWSCertificateManager", "AWS Certificate Manager", "Security, Identity and Compliance"),
    ("AWSCloudFormation", "AWS CloudFormation", "Management and Governance"),
    ("AWSCloudMap", "AWS Cloud Map", "Networking and Content Delivery"),
    ("AWSCloudTrail", "AWS CloudTrail", "Management and Governance"),
    ("AWSCloudWAN", "AWS Cloud WAN", "Networking and Content Delivery"),
    ("AWSCodeArtifact", "AWS CodeArtifact", "Developer Tools"),
    ("AWSCodeCommit", "AWS CodeCommit", "Developer Tools"),
    ("AWSCodeDeploy", "AWS CodeDeploy", "Developer Tools"),
    ("AWSCodePipeline", "AWS CodePipeline", "Developer Tools"),
    ("AWSComputeOptimizer", "AWS Compute Optimizer", "Developer Tools"),
    ("AWSConfig", "AWS Config", "Management and Governance"),
    ("AWSCostExplorer", "AWS Cost Explorer", "Cost Management"),
    ("AWSDataExchange", "AWS Data Exchange", "Migration and Transfer"),
    ("AWSDataSync", "AWS DataSync", "Migration and Transfer"),
    ("AWSDataTransfer", "AWS Data Transfer", "Migration and Transfer"),
    ("AWSDatabaseMigrationSvc", "AWS Database Migration Service", "Migration and Transfer"),
    ("AWSDeepRacer", "AWS DeepRacer", "AI and Machine Learning"),
    ("AWSDeveloperSupport", "AWS Developer Support", "Support"),
    ("AWSDeviceFarm", "AWS Device Farm", "Front-end Web and Mobile"),
    ("AWSDirectConnect", "AWS Direct Connect", "Networking and Content Delivery"),
    ("AWSDirectoryService", "AWS Directory Service", "Security, Identity and Compliance"),
    ("AWSELB", "AWS Elastic Load Balancing", "Networking and Content Delivery"),
    ("AWSElasticDisasterRecovery", "AWS Elastic Disaster Recovery", "Migration and Transfer"),
    ("AWSEntityResolution", "AWS Entity Resolution", "AI and Machine Learning"),
    ("AWSEvents", "Amazon EventBridge", "Management and Governance"),
    ("AWSFIS", "AWS Fault Injection Simulator", "Developer Tools"),
    ("AWSFMS", "AWS Firewall Manager", "Security, Identity and Compliance"),
    ("AWSGlobalAccelerator", "AWS Global Accelerator", "Networking and Content Delivery"),
    ("AWSGlue", "AWS Glue", "Analytics"),
    ("AWSGlueElasticViews", "AWS Glue Elastic Views", "Analytics"),
    ("AWSGroundStation", "AWS Ground Station", "Analytics"),
    ("AWSIAMAccessAnalyzer", "AWS IAM Access Analyzer", "Security, Identity and Compliance"),
    ("AWSLakeFormation", "AWS Lake Formation", "Analytics"),
    ("AWSLambda", "AWS Lambda", "Compute"),
    ("AWSM2", "AWS Mainframe Modernization", "Migration and Transfer"),
    ("AWSMDC", "AWS Modular Data Center", "Compute"),
    ("AWSManagedServices", "AWS Managed Services", "Management and Governance"),
    ("AWSMigrationHubRefactorSpaces", "AWS Migration Hub Refactor Spaces", "Migration and Transfer"),
    ("AWSNetworkFirewall", "AWS Network Firewall", "Networking and Content Delivery"),
    ("AWSOutposts", "AWS Outposts", "Compute"),
    ("AWSPCS", "AWS Parallel Computing Service", "Compute"),
    ("AWSQueueService", "Amazon Simple Queue Service", "Integration"),
    ("AWSR53AppRecoveryController", "Amazon Application Recovery Controller", "Networking and Content Delivery"),
    ("AWSRTBFabric", "AWS RTB Fabric", "Networking and Content Delivery"),
    ("AWSResilienceHub", "AWS Resilience Hub", "Management and Governance"),
    ("AWSSecretsManager", "AWS Secrets Manager", "Security, Identity and Compliance"),
    ("AWSSecurityHub", "AWS Security Hub", "Security, Identity and Compliance"),
    ("AWSServiceCatalog", "AWS Service Catalog", "Management and Governance"),
    ("AWSShield", "AWS Shield", "Security, Identity and Compliance"),
    ("AWSStorageGateway", "AWS Storage Gateway", "Storage"),
    ("AWSStorageGatewayDeepArchive", "AWS Storage Gateway Deep Archive", "Storage"),
    ("AWSSupportBusiness", "AWS Business Support", "Support"),
    ("AWSSupportEnterprise", "AWS Enterprise Support", "Support"),
    ("AWSSystemsManager", "AWS Systems Manager", "Management and Governance"),
    ("AWSTelcoNetworkBuilder", "AWS Telco Network Builder", "Management and Governance"),
    ("AWSTransfer", "AWS Transfer Family", "Migration and Transfer"),
    ("AWSWisdom", "Amazon Connect Wisdom", "AI and Machine Learning"),
    ("AWSXRay", "AWS X-Ray", "Developer Tools"),
    ("AmazonA2I", "Amazon Augmented AI", "AI and Machine Learning"),
    ("AmazonApiGateway", "Amazon API Gateway", "Networking and Content Delivery"),
    ("AmazonAthena", "Amazon Athena", "Analytics"),
    ("AmazonBedrock", "Amazon Bedrock", "AI and Machine Learning"),
    ("AmazonBedrockAgentCore", "Amazon Bedrock Agent Core", "AI and Machine Learning"),
    ("AmazonBedrockFoundationModels", "Amazon Bedrock Foundation Models", "AI and Machine Learning"),
    ("AmazonBedrockService", "Amazon Bedrock Service", "AI and Machine Learning"),
    ("AmazonBraket", "Amazon Braket", "Compute"),
    ("AmazonCloudDirectory", "Amazon Cloud Directory", "Security, Identity and Compliance"),
    ("AmazonCloudFront", "Amazon CloudFront", "Networking and Content Delivery"),
    ("AmazonCloudSearch", "Amazon Cloud Search", "Analytics"),
    ("AmazonCloudWatch", "Amazon CloudWatch", "Management and Governance"),
    ("AmazonCodeWhisperer", "Amazon CodeWhisperer", "Developer Tools"),
    ("AmazonCognito", "Amazon Cognito", "Security, Identity and Compliance"),
    ("AmazonCognitoSync", "Amazon Cognito Sync", "Security, Identity and Compliance"),
    ("AmazonDAX", "Amazon DynamoDB Accelerator", "Databases"),
    ("AmazonDataZone", "Amazon DataZone", "Analytics"),
    ("AmazonDetective", "Amazon Detective", "Security, Identity and Compliance"),
    ("AmazonDevOpsGuru", "Amazon DevOps Guru", "Developer Tools"),
    ("AmazonDocDB", "Amazon DocumentDB (with MongoDB compatibility)", "Databases"),
    ("AmazonDynamoDB", "Amazon DynamoDB", "Databases"),
    ("AmazonEC2", "Amazon Elastic Compute Cloud", "Compute"),
    ("AmazonEC2OCPULicenseFees", "Amazon EC2 OCPU License Fees", "Compute"),
    ("AmazonECR", "Amazon EC2 Container Registry (ECR)", "Containers"),
    ("AmazonECRPublic", "Amazon Elastic Container Registry Public", "Containers"),
    ("AmazonECS", "Amazon Elastic Container Service", "Containers"),
    ("AmazonEFS", "Amazon Elastic File System", "Storage"),
    ("AmazonEI", "Amazon Elastic Inference", "AI and Machine Learning"),
    ("AmazonEKS", "Amazon Elastic Container Service for Kubernetes", "Containers"),
    ("AmazonEKSAnywhere", "Amazon Elastic Container Service for Kubernetes Anywhere", "Containers"),
    ("AmazonES", "Amazon OpenSearch Service", "Analytics"),
    ("AmazonEVS", "Amazon Elastic VMware Service", "Compute"),
    ("AmazonElastiCache", "Amazon ElastiCache", "Databases"),
    ("AmazonFSx", "Amazon FSx", "Storage"),
    ("AmazonFinSpace", "Amazon FinSpace", "Analytics"),
    ("AmazonForecast", "Amazon Forecast", "AI and Machine Learning"),
    ("AmazonFraudDetector", "Amazon Fraud Detector", "AI and Machine Learning"),
    ("AmazonGlacier", "Amazon Glacier", "Storage"),
    ("AmazonGrafana", "Amazon Managed Grafana", "Management and Governance"),
    ("AmazonGuardDuty", "Amazon GuardDuty", "Security, Identity and Compliance"),
    ("AmazonHoneycode", "Amazon Honeycode", "Front-end Web and Mobile"),
    ("AmazonInspector", "Amazon Inspector", "Security, Identity and Compliance"),
    ("AmazonInspectorV2", "Amazon Inspector", "Security, Identity and Compliance"),
    ("AmazonKendra", "Amazon Kendra", "AI and Machine Learning"),
    ("AmazonKinesis", "Amazon Kinesis", "Analytics"),
    ("AmazonKinesisAnalytics", "Amazon Kinesis Analytics", "Analytics"),
    ("AmazonKinesisFirehose", "Amazon Kinesis Firehose", "Analytics"),
    ("AmazonLex", "Amazon Lex", "AI and Machine Learning"),
    ("AmazonLightsail", "Amazon Lightsail", "Compute"),
    ("AmazonLocationService", "Amazon Location Service", "Front-end Web and Mobile"),
    ("AmazonLookoutEquipment", "Amazon Lookout for Equipment", "AI and Machine Learning"),
    ("AmazonLookoutMetrics", "Amazon Lookout for Metrics", "AI and Machine Learning"),
    ("AmazonLookoutVision", "Amazon Lookout Vision", "AI and Machine Learning"),
    ("AmazonMCS", "Amazon Keyspaces (for Apache Cassandra)", "Databases"),
    ("AmazonML", "Amazon ML", "AI and Machine Learning"),
    ("AmazonMQ", "Amazon MQ", "Integration"),
    ("AmazonMSK", "Amazon Managed Streaming for Apache Kafka", "Analytics"),
    ("AmazonMWAA", "Amazon Managed Workflows for Apache Airflow", "Integration"),
    ("AmazonMacie", "Amazon Macie", "Security, Identity and Compliance"),
    ("AmazonMemoryDB", "Amazon MemoryDB", "Databases"),
    ("AmazonMonitron", "Amazon Monitron", "AI and Machine Learning"),
    ("AmazonNeptune", "Amazon Neptune", "Databases"),
    ("AmazonOmics", "Amazon Omics", "AI and Machine Learning"),
    ("AmazonPersonalize", "Amazon Personalize", "AI and Machine Learning"),
    ("AmazonPolly", "Amazon Polly", "AI and Machine Learning"),
    ("AmazonPrometheus", "Amazon Managed Service for Prometheus", "Management and Governance"),
    ("AmazonQ", "Amazon Q", "AI and Machine Learning"),
    ("AmazonQLDB", "Amazon Quantum Ledger Database", "Databases"),
    ("AmazonQuickSight", "Amazon QuickSight", "Analytics"),
    ("AmazonRDS", "Amazon Relational Database Service", "Databases"),
    ("AmazonRedshift", "Amazon Redshift", "Databases"),
    ("AmazonRekognition", "Amazon Rekognition", "AI and Machine Learning"),
    ("AmazonRoute53", "Amazon Route 53", "Networking and Content Delivery"),
    ("AmazonS3", "Amazon Simple Storage Service", "Storage"),
    ("AmazonS3GlacierDeepArchive", "Amazon S3 Glacier Deep Archive", "Storage"),
    ("AmazonSNS", "Amazon Simple Notification Service", "Integration"),
    ("AmazonSWF", "Amazon Simple Workflow Service", "Integration"),
    ("AmazonSageMaker", "Amazon SageMaker", "AI and Machine Learning"),
    ("AmazonSecurityLake", "Amazon Security Lake", "Security, Identity and Compliance"),
    ("AmazonSimpleDB", "Amazon SimpleDB", "Databases"),
    ("AmazonStates", "AWS Step Functions", "Compute"),
    ("AmazonTextract", "Amazon Textract", "AI and Machine Learning"),
    ("AmazonTimestream", "Amazon Timestream", "Databases"),
    ("AmazonVPC", "Amazon Virtual Private Cloud", "Networking and Content Delivery"),
    ("AmazonVerifiedPermissions", "Amazon Verified Permissions", "Security, Identity and Compliance"),
    ("AmazonWAM", "Amazon WorkSpaces Application Manager", "End User Computing"),
    ("AmazonWorkSpaces", "Amazon WorkSpaces", "End User Computing"),
    ("AmazonWorkSpacesThinClient", "Amazon WorkSpaces Thin Client", "End User Computing"),
    ("AmazonWorkSpacesWeb", "Amazon WorkSpaces Web", "End User Computing"),
    ("AppFlow", "Amazon AppFlow", "Integration"),
    ("AuroraDSQL", "Amazon Aurora DSQL", "Databases"),
    ("CloudHSM", "AWS CloudHSM", "Security, Identity and Compliance"),
    ("CodeBuild", "AWS CodeBuild", "Developer Tools"),
    ("CodeCatalyst", "Amazon CodeCatalyst", "Developer Tools"),
    ("CodeGuru", "AWS CodeGuru", "Developer Tools"),
    ("ElasticMapReduce", "Amazon Elastic MapReduce", "Analytics"),
    ("IngestionService", "Amazon OpenSearch Ingestion", "Analytics"),
    ("IngestionServiceSnowball", "AWS Snowball Ingestion", "Migration and Transfer"),
    ("OpsWorks", "AWS OpsWorks", "Management and Governance"),
    ("OracleDbAtAWS", "Oracle Database at AWS", "Databases"),
    ("PaymentCryptography", "AWS Payment Cryptography", "Security, Identity and Compliance"),
    ("SSMSAP", "AWS Systems Manager for SAP", "Management and Governance"),
    ("SimSpaceWeaver", "AWS SimSpace Weaver", "Compute"),
    ("SnowballExtraDays", "AWS Snowball Extra", "Migration and Transfer"),
    ("VMwareCloudOnAWS", "VMware Cloud in AWS", "Compute"),
    ("auditmanager", "AWS Audit Manager", "Security, Identity and Compliance"),
    ("awskms", "AWS Key Management Service", "Security, Identity and Compliance"),
    ("awswaf", "AWS WAF", "Security, Identity and Compliance"),
    ("comprehend", "Amazon Comprehend", "AI and Machine Learning"),
    ("comprehendmedical", "Amazon Comprehend Medical", "AI and Machine Learning"),
    ("datapipeline", "AWS Data Pipeline", "Developer Tools"),
    ("mobileanalytics", "AWS Mobile Analytics", "Analytics"),
    ("transcribe", "Amazon Transcribe", "AI and Machine Learning"),
    ("translate", "Amazon Translate", "AI and Machine Learning"),
]

# ---------------------------------------------------------------------------------------------
# Instance family and product -> (generation, processor, latest Intel, AMD and Graviton family, previous
# Intel family; 'none' = no target), for the general, compute, memory, burstable and storage classes c, i, m, r, t. Accelerated
# and special classes are given by a full table as a CSV: CostModels(seed_paths={"modernization": ...}).
# ---------------------------------------------------------------------------------------------
MODERNIZATION = [
    ("c1", "AmazonEC2", "Previous", "Intel", "c7i", "c7a", "c8g", "none"),
    ("c3", "AmazonEC2", "Previous", "Intel", "c7i", "c7a", "c8g", "c1"),
    ("c4", "AmazonEC2", "Previous", "Intel", "c7i", "c7a", "c8g", "c3"),
    ("c5", "AmazonEC2", "Previous", "Intel", "c7i", "c7a", "c8g", "c4"),
    ("c5a", "AmazonEC2", "Previous", "AMD", "c7i", "c7a", "c8g", "c4"),
    ("c5ad", "AmazonEC2", "Current", "AMD", "c6id", "none", "c8gd", "none"),
    ("c5d", "AmazonEC2", "Previous", "Intel", "c6id", "none", "c8gd", "none"),
    ("c5n", "AmazonEC2", "Previous", "Intel", "c6in", "none", "c7gn", "none"),
    ("c6a", "AmazonEC2", "Previous", "AMD", "c7i", "c7a", "c8g", "c5"),
    ("c6g", "AmazonEC2", "Previous", "Graviton", "c7i", "c7a", "c8g", "c5"),
    ("c6gd", "AmazonEC2", "Previous", "Graviton", "none", "none", "c8gd", "c5d"),
    ("c6gn", "AmazonEC2", "Previous", "Graviton", "none", "none", "c7gn", "c5n"),
    ("c6i", "AmazonEC2", "Previous", "Intel", "c7i", "c7a", "c8g", "c5"),
    ("c6id", "AmazonEC2", "Current", "Intel", "none", "none", "c8gd", "c5d"),
    ("c6in", "AmazonEC2", "Current", "Intel", "none", "none", "c7gn", "c5n"),
    ("c7a", "AmazonEC2", "Current", "AMD", "none", "none", "c8g", "c6i"),
    ("c7g", "AmazonEC2", "Previous", "Graviton", "none", "none", "c8g", "c6i"),
    ("c7gd", "AmazonEC2", "Previous", "Graviton", "none", "none", "c8gd", "c6id"),
    ("c7gn", "AmazonEC2", "Current", "Graviton", "none", "none", "none", "c6in"),
    ("c7i", "AmazonEC2", "Current", "Intel", "none", "none", "c8g", "c6i"),
    ("c7i-flex", "AmazonEC2", "Current", "Intel", "none", "none", "none", "none"),
    ("c8g", "AmazonEC2", "Current", "Graviton", "none", "none", "none", "c7i"),
    ("c8gd", "AmazonEC2", "Current", "Graviton", "none", "none", "none", "c6id"),
    ("i2", "AmazonEC2", "Previous", "Intel", "i7i", "none", "i8g", "none"),
    ("i3", "AmazonEC2", "Previous", "Intel", "i7i", "none", "i8g", "i2"),
    ("i3en", "AmazonEC2", "Current", "Intel", "none", "none", "none", "none"),
    ("i3p", "AmazonEC2", "Current", "Intel", "none", "none", "none", "none"),
    ("i4g", "AmazonEC2", "Previous", "Graviton", "i7i", "none", "i8g", "i3"),
    ("i4i", "AmazonEC2", "Previous", "Intel", "i7i", "none", "i8g", "i3"),
    ("i7i", "AmazonEC2", "Current", "Intel", "none", "none", "i8g", "i4i"),
    ("i7ie", "AmazonEC2", "Current", "Intel", "none", "none", "none", "none"),
    ("i8g", "AmazonEC2", "Current", "Graviton", "none", "none", "none", "i7i"),
    ("m1", "AmazonEC2", "Previous", "Intel", "m7i", "m7a", "m8g", "none"),
    ("m2", "AmazonEC2", "Previous", "Intel", "m7i", "m7a", "m8g", "m1"),
    ("m3", "AmazonEC2", "Previous", "Intel", "m7i", "m7a", "m8g", "m2"),
    ("m4", "AmazonEC2", "Previous", "Intel", "m7i", "m7a", "m8g", "m3"),
    ("m5", "AmazonEC2", "Previous", "Intel", "m7i", "m7a", "m8g", "m4"),
    ("m5a", "AmazonEC2", "Previous", "AMD", "m7i", "m7a", "m8g", "m4"),
    ("m5ad", "AmazonEC2", "Current", "AMD", "m6id", "none", "m8gd", "none"),
    ("m5d", "AmazonEC2", "Previous", "Intel", "m6id", "none", "m8gd", "none"),
    ("m5dn", "AmazonEC2", "Previous", "Intel", "m6idn", "none", "none", "none"),
    ("m5n", "AmazonEC2", "Previous", "Intel", "m6in", "none", "none", "none"),
    ("m5zn", "AmazonEC2", "Current", "Intel", "none", "none", "none", "none"),
    ("m6a", "AmazonEC2", "Previous", "AMD", "m7i", "m7a", "m8g", "m5"),
    ("m6g", "AmazonEC2", "Previous", "Graviton", "m7i", "m7a", "m8g", "m5"),
    ("m6gd", "AmazonEC2", "Previous", "Graviton", "none", "none", "m8gd", "m5d"),
    ("m6i", "AmazonEC2", "Previous", "Intel", "m7i", "m7a", "m8g", "m5"),
    ("m6id", "AmazonEC2", "Current", "Intel", "none", "none", "m8gd", "m5d"),
    ("m6idn", "AmazonEC2", "Current", "Intel", "none", "none", "none", "m5dn"),
    ("m6in", "AmazonEC2", "Current", "Intel", "none", "none", "none", "m5n"),
    ("m7a", "AmazonEC2", "Current", "AMD", "none", "none", "m8g", "m6i"),
    ("m7g", "AmazonEC2", "Previous", "Graviton", "none", "none", "m8g", "m6i"),
    ("m7gd", "AmazonEC2", "Previous", "Graviton", "none", "none", "m8gd", "m6id"),
    ("m7i", "AmazonEC2", "Current", "Intel", "none", "none", "m8g", "m6i"),
    ("m7i-flex", "AmazonEC2", "Current", "Intel", "none", "none", "none", "none"),
    ("m8g", "AmazonEC2", "Current", "Graviton", "none", "none", "none", "m7i"),
    ("m8gd", "AmazonEC2", "Current", "Graviton", "none", "none", "none", "m6id"),
    ("r3", "AmazonEC2", "Previous", "Intel", "r7i", "r7a", "r8g", "none"),
    ("r4", "AmazonEC2", "Previous", "Intel", "r7i", "r7a", "r8g", "r3"),
    ("r5", "AmazonEC2", "Previous", "Intel", "r7i", "r7a", "r8g", "r4"),
    ("r5a", "AmazonEC2", "Previous", "AMD", "r7i", "r7a", "r8g", "r4"),
    ("r5ad", "AmazonEC2", "Current", "AMD", "r6id", "none", "r8gd", "none"),
    ("r5b", "AmazonEC2", "Current", "Intel", "none", "none", "none", "none"),
    ("r5d", "AmazonEC2", "Previous", "Intel", "r6id", "none", "r8gd", "none"),
    ("r5dn", "AmazonEC2", "Previous", "Intel", "r6idn", "none", "none", "none"),
    ("r5n", "AmazonEC2", "Previous", "Intel", "r6in", "none", "none", "none"),
    ("r6a", "AmazonEC2", "Previous", "AMD", "r7i", "r7a", "r8g", "r5"),
    ("r6g", "AmazonEC2", "Previous", "Graviton", "r7i", "r7a", "r8g", "r5"),
    ("r6gd", "AmazonEC2", "Previous", "Graviton", "none", "none", "r8gd", "r5d"),
    ("r6i", "AmazonEC2", "Previous", "Intel", "r7i", "r7a", "r8g", "r5"),
    ("r6id", "AmazonEC2", "Current", "Intel", "none", "none", "r8gd", "r5d"),
    ("r6idn", "AmazonEC2", "Current", "Intel", "none", "none", "none", "r5dn"),
    ("r6in", "AmazonEC2", "Current", "Intel", "none", "none", "none", "r5n"),
    ("r7a", "AmazonEC2", "Current", "AMD", "none", "none", "r8g", "r6i"),
    ("r7g", "AmazonEC2", "Previous", "Graviton", "none", "none", "r8g", "r6i"),
    ("r7gd", "AmazonEC2", "Previous", "Graviton", "none", "none", "r8gd", "r6id"),
    ("r7i", "AmazonEC2", "Current", "Intel", "none", "none", "r8g", "r6i"),
    ("r7iz", "AmazonEC2", "Current", "Intel", "none", "none", "none", "none"),
    ("r8g", "AmazonEC2", "Current", "Graviton", "none", "none", "none", "r7i"),
    ("r8gd", "AmazonEC2", "Current", "Graviton", "none", "none", "none", "r6id"),
    ("t1", "AmazonEC2", "Previous", "Intel", "t3", "t3a", "t4g", "none"),
    ("t2", "AmazonEC2", "Previous", "Intel", "t3", "t3a", "t4g", "t1"),
    ("t3", "AmazonEC2", "Current", "Intel", "none", "none", "t4g", "t2"),
    ("t3a", "AmazonEC2", "Current", "AMD", "none", "none", "t4g", "t2"),
    ("t4g", "AmazonEC2", "Current", "Graviton", "none", "none", "none", "t3"),
    ("c1", "AmazonElastiCache", "Current", "Intel", "none", "none", "none", "none"),
    ("c7gn", "AmazonElastiCache", "Current", "Graviton", "none", "none", "none", "none"),
    ("m1", "AmazonElastiCache", "Previous", "Intel", "m5", "none", "m7g", "none"),
    ("m2", "AmazonElastiCache", "Previous", "Intel", "m5", "none", "m7g", "m1"),
    ("m3", "AmazonElastiCache", "Previous", "Intel", "m5", "none", "m7g", "m2"),
    ("m4", "AmazonElastiCache", "Previous", "Intel", "m5", "none", "m7g", "m3"),
    ("m5", "AmazonElastiCache", "Current", "Intel", "none", "none", "m7g", "m4"),
    ("m6g", "AmazonElastiCache", "Previous", "Graviton", "none", "none", "m7g", "m5"),
    ("m7g", "AmazonElastiCache", "Current", "Graviton", "none", "none", "none", "m5"),
    ("r3", "AmazonElastiCache", "Previous", "Intel", "r5", "none", "r7g", "none"),
    ("r4", "AmazonElastiCache", "Previous", "Intel", "r5", "none", "r7g", "r3"),
    ("r5", "AmazonElastiCache", "Current", "Intel", "none", "none", "r7g", "r4"),
    ("r6g", "AmazonElastiCache", "Previous", "Graviton", "none", "none", "r7g", "r5"),
    ("r6gd", "AmazonElastiCache", "Current", "Graviton", "none", "none", "none", "none"),
    ("r7g", "AmazonElastiCache", "Current", "Graviton", "none", "none", "none", "r5"),
    ("t1", "AmazonElastiCache", "Previous", "Intel", "t3", "none", "t4g", "none"),
    ("t2", "AmazonElastiCache", "Previous", "Intel", "t3", "none", "t4g", "t1"),
    ("t3", "AmazonElastiCache", "Current", "Intel", "none", "none", "t4g", "t2"),
    ("t4g", "AmazonElastiCache", "Current", "Graviton", "none", "none", "none", "t3"),
    ("c6gd", "AmazonRDS", "Current", "Graviton", "none", "none", "none", "none"),
    ("m1", "AmazonRDS", "Previous", "Intel", "m7i", "none", "m8g", "none"),
    ("m2", "AmazonRDS", "Previous", "Intel", "m7i", "none", "m8g", "m1"),
    ("m3", "AmazonRDS", "Previous", "Intel", "m7i", "none", "m8g", "m2"),
    ("m4", "AmazonRDS", "Previous", "Intel", "m7i", "none", "m8g", "m3"),
    ("m5", "AmazonRDS", "Previous", "Intel", "m7i", "none", "m8g", "m4"),
    ("m5d", "AmazonRDS", "Previous", "Intel", "m6id", "none", "m6gd", "none"),
    ("m6g", "AmazonRDS", "Previous", "Graviton", "m7i", "none", "m8g", "m5"),
    ("m6gd", "AmazonRDS", "Current", "Graviton", "none", "none", "none", "m5d"),
    ("m6i", "AmazonRDS", "Previous", "Intel", "m7i", "none", "m8g", "m5"),
    ("m6id", "AmazonRDS", "Current", "Intel", "none", "none", "none", "m5d"),
    ("m6idn", "AmazonRDS", "Current", "Intel", "none", "none", "none", "none"),
    ("m6in", "AmazonRDS", "Current", "Intel", "none", "none", "none", "none"),
    ("m7g", "AmazonRDS", "Previous", "Graviton", "none", "none", "m8g", "m6i"),
    ("m7i", "AmazonRDS", "Current", "Intel", "none", "none", "m8g", "m6i"),
    ("m8g", "AmazonRDS", "Current", "Graviton", "none", "none", "none", "m7i"),
    ("r3", "AmazonRDS", "Previous", "Intel", "r7i", "none", "r8g", "none"),
    ("r4", "AmazonRDS", "Previous", "Intel", "r7i", "none", "r8g", "r3"),
    ("r5", "AmazonRDS", "Previous", "Intel", "r7i", "none", "r8g", "r4"),
    ("r5b", "AmazonRDS", "Current", "Intel", "none", "none", "none", "none"),
    ("r5d", "AmazonRDS", "Previous", "Intel", "r6id", "none", "r6gd", "none"),
    ("r6g", "AmazonRDS", "Previous", "Graviton", "r7i", "none", "r8g", "r5"),
    ("r6gd", "AmazonRDS", "Current", "Graviton", "none", "none", "none", "r5d"),
    ("r6i", "AmazonRDS", "Previous", "Intel", "r7i", "none", "r8g", "r5"),
    ("r6id", "AmazonRDS", "Current", "Intel", "none", "none", "none", "r5d"),
    ("r6idn", "AmazonRDS", "Current", "Intel", "none", "none", "none", "none"),
    ("r6in", "AmazonRDS", "Current", "Intel", "none", "none", "none", "none"),
    ("r7g", "AmazonRDS", "Previous", "Graviton", "none", "none", "r8g", "r6i"),
    ("r7i", "AmazonRDS", "Current", "Intel", "none", "none", "r8g", "r6i"),
    ("r8g", "AmazonRDS", "Current", "Graviton", "none", "none", "none", "r7i"),
    ("t1", "AmazonRDS", "Previous", "Intel", "t3", "none", "t4g", "none"),
    ("t2", "AmazonRDS", "Previous", "Intel", "t3", "none", "t4g", "t1"),
    ("t3", "AmazonRDS", "Current", "Intel", "none", "none", "t4g", "t2"),
    ("t4g", "AmazonRDS", "Current", "Graviton", "none", "none", "none", "t3"),
    ("c4", "AmazonES", "Previous", "Intel", "c7i", "none", "c7g", "none"),
    ("c5", "AmazonES", "Previous", "Intel", "c7i", "none", "c7g", "c4"),
    ("c6g", "AmazonES", "Previous", "Graviton", "c7i", "none", "c7g", "c5"),
    ("c7g", "AmazonES", "Current", "Graviton", "none", "none", "none", "c5"),
    ("c7i", "AmazonES", "Current", "Intel", "none", "none", "none", "c5"),
    ("i2", "AmazonES", "Previous", "Intel", "i4i", "none", "i4g", "none"),
    ("i3", "AmazonES", "Previous", "Intel", "i4i", "none", "i4g", "i2"),
    ("i4g", "AmazonES", "Current", "Graviton", "none", "none", "none", "i3"),
    ("i4i", "AmazonES", "Current", "Intel", "none", "none", "none", "i3"),
    ("m3", "AmazonES", "Previous", "Intel", "m7i", "none", "m7g", "none"),
    ("m4", "AmazonES", "Previous", "Intel", "m7i", "none", "m7g", "m3"),
    ("m5", "AmazonES", "Previous", "Intel", "m7i", "none", "m7g", "m4"),
    ("m6g", "AmazonES", "Previous", "Graviton", "m7i", "none", "m7g", "m5"),
    ("m7g", "AmazonES", "Current", "Graviton", "none", "none", "none", "m5"),
    ("m7i", "AmazonES", "Current", "Intel", "none", "none", "none", "m5"),
    ("r3", "AmazonES", "Previous", "Intel", "r7i", "none", "r7g", "none"),
    ("r4", "AmazonES", "Previous", "Intel", "r7i", "none", "r7g", "r3"),
    ("r5", "AmazonES", "Previous", "Intel", "r7i", "none", "r7g", "r4"),
    ("r6g", "AmazonES", "Previous", "Graviton", "r7i", "none", "r7g", "r5"),
    ("r6gd", "AmazonES", "Previous", "Graviton", "none", "none", "r7gd", "none"),
    ("r7g", "AmazonES", "Current", "Graviton", "none", "none", "none", "r5"),
    ("r7gd", "AmazonES", "Current", "Graviton", "none", "none", "none", "none"),
    ("r7i", "AmazonES", "Current", "Intel", "none", "none", "none", "r5"),
    ("t2", "AmazonES", "Previous", "Intel", "t3", "none", "none", "none"),
    ("t3", "AmazonES", "Current", "Intel", "none", "none", "none", "t2"),
]


REGION_SCHEMA = T.StructType([T.StructField(n, T.DoubleType() if n.endswith("tude") else T.StringType()) for n in
                              ["region_id", "region_name", "region_country", "region_city", "region_latitude",
                               "region_longitude", "region_timezone"]])
PRODUCT_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in
                               ["product_code", "service_nice_name", "service_category"]])
MODERNIZATION_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in
                                     ["family", "product", "generation", "instance_processor",
                                      "latest_intel", "latest_amd", "latest_graviton", "previous_intel"]])

SEEDS = {
    "regions": (REGIONS, REGION_SCHEMA),
    "products": (PRODUCTS, PRODUCT_SCHEMA),
    "modernization": (MODERNIZATION, MODERNIZATION_SCHEMA),
}


def seed_rows(name: str):
    return SEEDS[name][0]


def load_seed(spark: SparkSession, name: str, path: str | None = None) -> DataFrame:
    """Typed seed table; no join hint. Spark knows the size of the built-in rows and of a CSV at ``path`` (in
    shared storage, of any size) and broadcasts what lies below its threshold."""
    _, schema = SEEDS[name]
    if path:
        return spark.read.schema(schema).option("header", True).csv(path)
    return local_rows(spark, seed_rows(name), schema)


def local_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A few rows as a relation of known size, which a join broadcasts; rows of a Python list become an RDD of unknown
    size, for which a join would shuffle all lines by the seed's few keys."""
    columns = [pa.array([r[i] for r in rows]) for i in range(len(schema.fields))]
    return spark.createDataFrame(pa.table(columns, names=schema.names), schema)


def seed_values_sql(name: str) -> str:
    """The seed as a SQL VALUES relation (used by the DuckDB oracle)."""
    _, schema = SEEDS[name]
    cols = [f.name for f in schema.fields]

    def q(v):
        if isinstance(v, float):
            return f"CAST({v} AS DOUBLE)"
        return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"

    body = ",\n".join("(" + ", ".join(q(v) for v in r) + ")" for r in seed_rows(name))
    return f"(VALUES {body}) AS t({', '.join(cols)})"
