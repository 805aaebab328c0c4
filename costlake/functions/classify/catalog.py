"""Catalogue of usage classification rule sets: family -> rule set -> (applies-to, rules, default),
and the service-code dispatcher over all of them."""

from __future__ import annotations

from costlake.functions.classify import compute as CP
from costlake.functions.classify import database as DB
from costlake.functions.classify import families as FM
from costlake.functions.classify import monitoring as MON
from costlake.functions.classify import network as NW
from costlake.functions.classify import security as SEC
from costlake.functions.classify import storage as ST


def _svc(*codes):
    return ("in", "service_code", list(codes)) if len(codes) > 1 else ("eq", "service_code", codes[0])


# rule set name -> (condition selecting the rows it applies to, rules, default label)
RULE_SETS = {
    # analytics
    "athena": (_svc("AmazonAthena"), FM.ATHENA, "Athena [Other]"),
    "emr": (_svc("ElasticMapReduce"), FM.EMR, "EMR [Other]"),
    "glue": (_svc("AWSGlue"), FM.GLUE, "Glue [Other]"),
    "kinesis_analytics": (_svc("AmazonKinesisAnalytics"), FM.KINESIS_ANALYTICS, "Kinesis Analytics [Other]"),
    "kinesis": (_svc("AmazonKinesis"), FM.KINESIS, "Kinesis [Other]"),
    "kinesis_firehose": (_svc("AmazonKinesisFirehose"), FM.FIREHOSE, "Firehose [Other]"),
    "msk": (_svc("AmazonMSK"), FM.MSK, "MSK [Other]"),
    "quicksight": (_svc("AmazonQuickSight"), FM.QUICKSIGHT, "QuickSight [Other]"),
    # compute
    "batch": (_svc("AWSBatch"), FM.BATCH, "Batch [Other]"),
    "dax": (_svc("AmazonDAX"), FM.DAX, "DAX [Other]"),
    "ec2": (_svc("AmazonEC2"), CP.EC2, CP.EC2_DEFAULT),
    "ecr": (_svc("AmazonECR"), FM.ECR, "ECR [Other]"),
    "ecs": (_svc("AmazonECS"), FM.ECS, "ECS [Other]"),
    "eks": (_svc("AmazonEKS"), FM.EKS, "EKS [Other]"),
    "lambda": (_svc("AWSLambda"), CP.LAMBDA, CP.LAMBDA_DEFAULT),
    "outposts": (_svc("AmazonOutposts"), FM.OUTPOSTS, "Outposts [Other]"),
    # database
    "documentdb": (_svc("AmazonDocDB"), DB.DOCUMENTDB, DB.DOCUMENTDB_DEFAULT),
    "dynamodb": (_svc("AmazonDynamoDB"), DB.DYNAMODB, DB.DYNAMODB_DEFAULT),
    "elasticache": (_svc("AmazonElastiCache"), DB.ELASTICACHE, DB.ELASTICACHE_DEFAULT),
    "memorydb": (_svc("AmazonMemoryDB"), DB.MEMORYDB, DB.MEMORYDB_DEFAULT),
    "neptune": (_svc("AmazonNeptune"), DB.NEPTUNE, DB.NEPTUNE_DEFAULT),
    "opensearch": (_svc("AmazonES"), DB.OPENSEARCH, DB.OPENSEARCH_DEFAULT),
    "rds": (_svc("AmazonRDS"), DB.RDS, DB.RDS_DEFAULT),
    "redshift": (_svc("AmazonRedshift"), DB.REDSHIFT, DB.REDSHIFT_DEFAULT),
    # management
    "awssupport": (_svc("AWSSupportEnterprise"), FM.AWS_SUPPORT, "AWS Support Enterprise [Other]"),
    "compute_savings_plans": (_svc("ComputeSavingsPlans"), FM.COMPUTE_SAVINGS_PLANS, "Compute Savings Plans [Other]"),
    "cost_explorer": (_svc("AWSCostExplorer"), FM.COST_EXPLORER, "Cost Explorer [Other]"),
    # messaging
    "mq": (_svc("AmazonMQ"), FM.MQ, "MQ [Other]"),
    "sns": (_svc("AmazonSNS"), FM.SNS, "SNS [Other]"),
    "sqs": (_svc("AWSQueueService"), FM.SQS, "SQS [Other]"),
    # ml
    "bedrock": (_svc("AmazonBedrock"), FM.BEDROCK, "Bedrock [Other]"),
    "sagemaker": (_svc("AmazonSageMaker"), FM.SAGEMAKER, "SageMaker [Other]"),
    # monitoring
    "cloudwatch": (_svc("AmazonCloudWatch"), MON.CLOUDWATCH, MON.CLOUDWATCH_DEFAULT),
    "xray": (_svc("AWSXRay"), FM.XRAY, "X-Ray [Other]"),
    # network
    "api_gateway": (_svc("AmazonApiGateway"), NW.API_GATEWAY, "API Gateway [Other]"),
    "cloudfront": (_svc("AmazonCloudFront"), NW.CLOUDFRONT, "CloudFront [Other]"),
    "data_transfer": (("in", "product_family", ["Data Transfer", "DT-Data Transfer"]), NW.DATA_TRANSFER,
                      NW.DATA_TRANSFER_DEFAULT),
    "elb": (_svc("AWSELB"), NW.ELB, "ELB [Other]"),
    "nat_gateway": (("like", "usage_type", "%NatGateway%"), NW.NAT_GATEWAY, NW.NAT_GATEWAY_DEFAULT),
    "network": (_svc("AmazonVPC", "AWSDirectConnect"), NW.NETWORK, NW.NETWORK_DEFAULT),
    "route53": (_svc("AmazonRoute53"), NW.ROUTE53, "Route 53 [Other]"),
    "transfer": (_svc("AWSTransfer"), NW.TRANSFER, "Transfer [Other]"),
    # security
    "awswaf": (_svc("awswaf"), SEC.WAF, "WAF [Other]"),
    "backup": (_svc("AWSBackup"), SEC.BACKUP, "AWS Backup [Other]"),
    "certificate_manager": (_svc("AWSCertificateManager"), SEC.CERTIFICATE_MANAGER, "Certificate Manager [Other]"),
    "cloudhsm": (_svc("CloudHSM"), SEC.CLOUDHSM, "CloudHSM [Other]"),
    "cloudtrail": (_svc("AWSCloudTrail"), SEC.CLOUDTRAIL, "CloudTrail [Other]"),
    "cognito": (_svc("AmazonCognito"), SEC.COGNITO, "Cognito [Other]"),
    "config": (_svc("AWSConfig"), SEC.CONFIG, "AWS Config [Other]"),
    "guardduty": (_svc("AmazonGuardDuty"), SEC.GUARDDUTY, "GuardDuty [Other]"),
    "kms": (_svc("awskms"), SEC.KMS, "KMS [Other]"),
    "security_hub": (_svc("AWSSecurityHub"), SEC.SECURITY_HUB, "Security Hub [Other]"),
    "shield": (_svc("AWSShield"), SEC.SHIELD, "Shield [Other]"),
    # storage
    "ebs": (("and", _svc("AmazonEC2"), ("like", "usage_type", "%EBS:%")), ST.EBS, ST.EBS_DEFAULT),
    "efs": (_svc("AmazonEFS"), ST.EFS, "EFS [Other]"),
    "s3": (_svc("AmazonS3"), ST.S3, ST.S3_DEFAULT),
}

FAMILIES = {
    "analytics": ["athena", "emr", "glue", "kinesis_analytics", "kinesis", "kinesis_firehose", "msk", "quicksight"],
    "compute": ["batch", "dax", "ec2", "ecr", "ecs", "eks", "lambda", "outposts"],
    "database": ["documentdb", "dynamodb", "elasticache", "memorydb", "neptune", "opensearch", "rds", "redshift"],
    "management": ["awssupport", "compute_savings_plans", "cost_explorer"],
    "messaging": ["mq", "sns", "sqs"],
    "ml": ["bedrock", "sagemaker"],
    "monitoring": ["cloudwatch", "xray"],
    "network": ["api_gateway", "cloudfront", "data_transfer", "elb", "nat_gateway", "network", "route53", "transfer"],
    "security": ["awswaf", "backup", "certificate_manager", "cloudhsm", "cloudtrail", "cognito", "config",
                 "guardduty", "kms", "security_hub", "shield"],
    "storage": ["ebs", "efs", "s3"],
}

# The unified dispatcher: service code -> rule set, in order; Marketplace lines take the service name.
# The secrets-manager rule set it names is defined nowhere; its lines get one fixed label (defect D8).
SECRETS_MANAGER_LABEL = "Secrets Manager [Other]"
DISPATCH = [
    ("AWSELB", "elb"), (("AmazonVPC", "AWSDirectConnect"), "network"), ("AmazonEC2", "ec2"), ("AmazonS3", "s3"),
    ("AmazonElastiCache", "elasticache"), ("AmazonES", "opensearch"), ("AmazonRDS", "rds"),
    ("AmazonDynamoDB", "dynamodb"), ("AmazonRedshift", "redshift"), ("AmazonDocDB", "documentdb"),
    ("AmazonMemoryDB", "memorydb"), ("AmazonNeptune", "neptune"), ("AmazonECS", "ecs"), ("AmazonEKS", "eks"),
    ("AmazonCloudWatch", "cloudwatch"), ("AmazonQuickSight", "quicksight"), ("AWSLambda", "lambda"),
    ("AWSBatch", "batch"), ("AmazonAthena", "athena"), ("AmazonEFS", "efs"), ("AmazonGuardDuty", "guardduty"),
    ("AmazonKinesis", "kinesis"), ("AmazonMSK", "msk"), ("AmazonSageMaker", "sagemaker"), ("AWSBackup", "backup"),
    ("AWSGlue", "glue"), ("ElasticMapReduce", "emr"), ("awskms", "kms"), ("AWSSecretsManager", None),
    ("AWSSecurityHub", "security_hub"), ("AWSCloudTrail", "cloudtrail"), ("AWSConfig", "config"),
    ("ComputeSavingsPlans", "compute_savings_plans"), ("AWSSupportEnterprise", "awssupport"), ("awswaf", "awswaf"),
    ("AWSQueueService", "sqs"), ("AmazonECR", "ecr"), ("AmazonKinesisAnalytics", "kinesis_analytics"),
    ("AmazonKinesisFirehose", "kinesis_firehose"), ("AmazonSNS", "sns"), ("AmazonBedrock", "bedrock"),
    ("AmazonCognito", "cognito"), ("AWSShield", "shield"), ("AmazonApiGateway", "api_gateway"),
    ("AmazonCloudFront", "cloudfront"), ("AmazonRoute53", "route53"), ("AWSCostExplorer", "cost_explorer"),
    ("CloudHSM", "cloudhsm"), ("AWSTransfer", "transfer"), ("AWSXRay", "xray"),
    ("AWSCertificateManager", "certificate_manager"), ("AmazonOutposts", "outposts"), ("AmazonMQ", "mq"),
    ("AmazonDAX", "dax"),
]


def unified_rules():
    rules = [(("eq", "billing_entity", "AWS Marketplace"), ("col", "service_name"))]
    for codes, name in DISPATCH:
        cond = _svc(*codes) if isinstance(codes, tuple) else _svc(codes)
        label = SECRETS_MANAGER_LABEL if name is None else ("rules", RULE_SETS[name][1], RULE_SETS[name][2])
        rules.append((cond, label))
    return rules, "Others"
