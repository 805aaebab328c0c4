"""Security rule sets. Patterns and labels, first match wins."""

from __future__ import annotations

from costlake.functions.classify import like_rules
from costlake.functions.classify.families import A, L, N, O

UT = "usage_type"

WAF = [
    (A(L("%WebACL%"), N("%Shield%")), "WAF Web ACLs [Management]"),
    (L("%ShieldProtected-WebACL%"), "WAF Shield Protected Web ACLs [Management]"),
    (A(L("%Rule%"), N("%Shield%"), N("%Request%")), "WAF Rules [Management]"),
    (L("%ShieldProtected-Rule%"), "WAF Shield Protected Rules [Management]"),
] + [(A(L("%Request%"), L(f"%Tier{i}%"), N("%Shield%")), f"WAF Requests Tier {i} [Processing]") for i in range(1, 8)] + [
    (A(L("%Request%"), N("%Shield%"), N("%Tier%")), "WAF Requests Standard [Processing]"),
    (L("%ShieldProtected-Request%"), "WAF Shield Protected Requests [Processing]"),
    (A(L("%AMR-BotControl%"), N("%Request%"), N("%Shield%")), "WAF Bot Control [Security]"),
    (A(L("%AMR-BotControl-Request%"), N("%Shield%")), "WAF Bot Control Requests [Security]"),
    (L("%AMR-BotControl-Targeted-Request%"), "WAF Bot Control Targeted Requests [Security]"),
    (L("%ShieldProtected-AMR-BotControl%"), "WAF Shield Protected Bot Control [Security]"),
    (A(L("%AMR-ATP%"), N("%Shield%")), "WAF Account Takeover Protection [Security]"),
    (L("%ShieldProtected-AMR-ATP%"), "WAF Shield Protected ATP [Security]"),
    (A(L("%AMR-FraudControl%"), N("%Shield%")), "WAF Fraud Control [Security]"),
    (L("%ShieldProtected-AMR-FraudControl%"), "WAF Shield Protected Fraud Control [Security]"),
    (L("%CaptchaAttempted%"), "WAF CAPTCHA Attempts [Security]"),
    (A(L("%ChallengeServed%"), N("%Shield%")), "WAF Challenge Responses [Security]"),
    (L("%ShieldProtected-ChallengeServed%"), "WAF Shield Protected Challenges [Security]"),
]
BACKUP = like_rules(UT, [
    ("%WarmStorage-ByteHrs%", "AWS Backup Warm Storage [Storage]"),
    ("%ColdStorage-ByteHrs%", "AWS Backup Cold Storage [Storage]"),
    ("%-LAGV%", "AWS Backup Legal Archive [Storage]"),
    ("%CrossRegion-%", "AWS Backup Cross-Region [Network]"),
]) + [(O(L("%Restore-%"), L("%PartialRestore-%")), "AWS Backup Restore [Management]")] + like_rules(UT, [
    ("%BackupEvaluations%", "AWS Backup Evaluations [Management]"),
    ("%RT-RecoveryPoint%", "AWS Backup Recovery Testing [Management]"),
    ("%EarlyDelete%", "AWS Backup Early Delete [Management]"),
    ("%DataTransfer-%", "AWS Backup Data Transfer [Network]"),
])
CERTIFICATE_MANAGER = like_rules(UT, [
    ("%PaidPrivateCA%", "Certificate Manager Private CA [Security]"),
    ("%FreePrivateCA%", "Certificate Manager Free Private CA [Security]"),
    ("%PrivateCertificatesIssued%", "Certificate Manager Private Certificates [Security]"),
    ("%ShortLivedCertificatesIssued%", "Certificate Manager Short-Lived Certificates [Security]"),
    ("%ShortLivedCertificatePrivateCA%", "Certificate Manager Short-Lived Private CA [Security]"),
    ("%OCSPPerQuery%", "Certificate Manager OCSP Queries [Security]"),
    ("%OCSPResponseHandling%", "Certificate Manager OCSP Response Handling [Security]"),
])
CLOUDHSM = [
    (A(L("%CloudHSMv2Usage%"), L("%hsm2m.m%")), "CloudHSM v2 hsm2m.medium [Security]"),
    (A(L("%CloudHSMv2Usage%"), N("%hsm2m.m%")), "CloudHSM v2 hsm1.medium [Security]"),
]
CLOUDTRAIL = like_rules(UT, [
    ("%InsightsEvents%", "CloudTrail Insights Events [Security]"),
    ("%PaidEventsRecorded%", "CloudTrail Paid Management Events [Security]"),
    ("%FreeEventsRecorded%", "CloudTrail Free Management Events [Security]"),
    ("%DataEventsRecorded%", "CloudTrail Data Events [Security]"),
    ("%NetworkEventsRecorded%", "CloudTrail Network Events [Security]"),
    ("%Ingestion-Bytes-1yearstore-Live-CloudTrail-Logs%", "CloudTrail Lake 1-Year Live Logs [Storage]"),
    ("%Ingestion-Bytes-1yearstore-Other-data-sources%", "CloudTrail Lake 1-Year Other Sources [Storage]"),
]) + [
    (A(L("%Ingestion-Bytes%"), N("%1yearstore%"), N("%FreeTrial%")), "CloudTrail Lake 7-Year Ingestion [Storage]"),
    (L("%FreeTrialIngestion-Bytes%"), "CloudTrail Lake Free Trial Ingestion [Storage]"),
    (A(L("%QueryScanned-Bytes%"), N("%FreeTrial%")), "CloudTrail Lake Query Scanning [Management]"),
    (L("%FreeTrialQueryScanned-Bytes%"), "CloudTrail Lake Free Trial Queries [Management]"),
]
COGNITO = [
    (A(L("%UserPool%"), L("%MAU%")), "Cognito User Pool Monthly Active Users [Processing]"),
    (A(L("%UserPool%"), L("%SMS%")), "Cognito User Pool SMS [Processing]"),
    (A(L("%UserPool%"), L("%Email%")), "Cognito User Pool Email [Processing]"),
    (A(L("%UserPool%"), N("%MAU%"), N("%SMS%"), N("%Email%")), "Cognito User Pool Operations [Processing]"),
    (L("%IdentityPool%"), "Cognito Identity Pool Operations [Processing]"),
    (L("%AdvancedSecurity%"), "Cognito Advanced Security Features [Security]"),
    (L("%SAML%"), "Cognito SAML Operations [Processing]"),
]
CONFIG = [
    (A(L("%ConfigurationItemRecorded%"), N("%Daily%")), "AWS Config Configuration Items [Management]"),
    (L("%ConfigurationItemRecordedDaily%"), "AWS Config Daily Configuration Items [Management]"),
    (L("%ConfigRuleEvaluations%"), "AWS Config Rule Evaluations [Security]"),
    (L("%ConformancePackEvaluations%"), "AWS Config Conformance Pack Evaluations [Security]"),
]
GUARDDUTY = [
    (A(L("%PaidEventsAnalyzed%"), N("%-Bytes%")), "GuardDuty Events Analysis [Security]"),
    (L("%PaidEventsAnalyzed-Bytes%"), "GuardDuty VPC Flow Logs Analysis [Security]"),
    (A(L("%FreeEventsAnalyzed%"), N("%-Bytes%")), "GuardDuty Free Events Analysis [Security]"),
    (L("%FreeEventsAnalyzed-Bytes%"), "GuardDuty Free VPC Flow Logs [Security]"),
] + like_rules(UT, [
    ("%PaidS3DataEventsAnalyzed%", "GuardDuty S3 Protection [Security]"),
    ("%FreeS3DataEventsAnalyzed%", "GuardDuty Free S3 Protection [Security]"),
    ("%PaidKubernetesAuditLogsAnalyzed%", "GuardDuty Kubernetes Audit Logs [Security]"),
    ("%FreeKubernetesAuditLogsAnalyzed%", "GuardDuty Free Kubernetes Audit Logs [Security]"),
    ("%PaidEKSvCPUMonitored%", "GuardDuty EKS Runtime Monitoring [Security]"),
    ("%FreeEKSvCPUMonitored%", "GuardDuty Free EKS Runtime Monitoring [Security]"),
    ("%PaidLambdaNetworkLogsAnalyzed-Bytes%", "GuardDuty Lambda Protection [Security]"),
    ("%FreeLambdaNetworkLogsAnalyzed-Bytes%", "GuardDuty Free Lambda Protection [Security]"),
    ("%PaidEC2vCPUMonitored%", "GuardDuty EC2 Runtime Monitoring [Security]"),
    ("%FreeEC2vCPUMonitored%", "GuardDuty Free EC2 Runtime Monitoring [Security]"),
    ("%PaidFargatevCPUMonitored%", "GuardDuty Fargate Runtime Monitoring [Security]"),
    ("%FreeFargatevCPUMonitored%", "GuardDuty Free Fargate Runtime Monitoring [Security]"),
    ("%PaidRDSvCPUMonitored%", "GuardDuty RDS Protection [Security]"),
    ("%FreeRDSvCPUMonitored%", "GuardDuty Free RDS Protection [Security]"),
    ("%PaidRDSACUMonitored%", "GuardDuty RDS Aurora Serverless Protection [Security]"),
    ("%FreeRDSACUMonitored%", "GuardDuty Free RDS Aurora Serverless Protection [Security]"),
    ("%MalwareProtectionS3ScanRequest%", "GuardDuty S3 Malware Scan Requests [Security]"),
    ("%MalwareProtectionS3DataScanned%", "GuardDuty S3 Malware Data Scanned [Security]"),
    ("%PaidMalwareProtectionEBSDataScanned%", "GuardDuty EBS Malware Protection [Security]"),
    ("%PaidOnDemandEBSVolumeDataScanned%", "GuardDuty EBS On-Demand Scan [Security]"),
    ("%FreeMalwareProtectionEBSDataScanned%", "GuardDuty Free EBS Malware Protection [Security]"),
])
KMS = [
    (L("%KMS-Keys%"), "KMS Keys [Management]"),
    (A(L("%KMS-Requests%"), N("%Asymmetric%"), N("%GenerateDatakeyPair%")), "KMS Standard Requests [Security]"),
    (A(L("%Requests-Asymmetric%"), N("%RSA_2048%")), "KMS Asymmetric Requests [Security]"),
    (L("%KMS-Requests-Asymmetric-RSA_2048%"), "KMS RSA 2048 Requests [Security]"),
    (L("%KMS-Requests-GenerateDatakeyPair-RSA%"), "KMS RSA Data Key Pair Generation [Security]"),
    (L("%Requests-GenerateDatakeyPair-ECC%"), "KMS ECC Data Key Pair Generation [Security]"),
]
SECURITY_HUB = like_rules(UT, [
    ("%PaidComplianceCheck%", "Security Hub Compliance Checks [Security]"),
    ("%FreeComplianceCheck%", "Security Hub Free Compliance Checks [Security]"),
    ("%OtherProduct:PaidFindingsIngestion%", "Security Hub Paid Findings Ingestion [Security]"),
    ("%SecurityHubProduct:FreeFindingsIngestion%", "Security Hub Free Findings Ingestion [Security]"),
    ("%FreeFindingsIngestion-CrossRegion%", "Security Hub Free Cross-Region Findings [Security]"),
    ("%OtherProduct:FreeFindingsIngestion-FreeTrial%", "Security Hub Free Trial Findings [Security]"),
]) + [
    (A(L("%RuleEvaluation%"), N("%FreeTrial%")), "Security Hub Rule Evaluation [Security]"),
    (L("%RuleEvaluation-FreeTrial%"), "Security Hub Free Rule Evaluation [Security]"),
]
SHIELD = like_rules(UT, [("%DRT%", "Shield DDoS Response Team [Security]"),
                         ("%AdvancedProtection%", "Shield Advanced Protection [Security]"),
                         ("%Subscription%", "Shield Advanced Subscription [Security]")])
