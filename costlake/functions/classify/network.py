"""Network rule sets. Patterns and labels as the classification defines them."""

from __future__ import annotations

UT, OP, SC = "usage_type", "operation", "service_code"

# ---- data transfer ------------------------------------------------------------------------------
DATA_TRANSFER = [
    (("or", ("eq", OP, "VPCPeering-In"), ("eq", OP, "VPCPeering-Out")), "Data Transfer [VPC Peering]"),
    (("and", ("eq", OP, "CreateVpnConnection"),
      ("or", ("like", UT, "%DataTransfer-Out-Bytes%"), ("like", UT, "%AWS-Out-Bytes%"))),
     "Data Transfer [Region to VPN]"),
    (("or", ("like", UT, "%AWS-Out-Bytes%"), ("like", UT, "%S3RTC%")), "Data Transfer [Region to Region]"),
    (("or", ("eq", SC, "AWSDirectConnect"), ("like", UT, "%DataXfer%")), "Data Transfer [Region to DirectConnect]"),
    (("eq", SC, "AmazonCloudFront"), "Data Transfer [Amazon CloudFront]"),
    (("or", ("like", UT, "%DataTransfer-Out-Bytes%"), ("like", UT, "%DataTransfer-Out-ABytes%")),
     "Data Transfer [Region to Internet]"),
    (("like", UT, "%DataTransfer-Regional-Bytes%"), "Data Transfer [Inter AZ]"),
    (("like", UT, "%TransitGateway-Bytes%"), "Data Transfer [Transit Gateway Data Processed]"),
    (("like", UT, "%NatGateway-Bytes%"), "Data Transfer [NAT Gateway Data Processed]"),
]
DATA_TRANSFER_DEFAULT = "Data Transfer [Other]"

# ---- NAT gateway (macro form: unmatched usage types keep their own text) --------------------------
NAT_GATEWAY = [
    (("like", UT, "%NatGateway-Bytes"), "NAT Gateway Data Processing Charge"),
    (("like", UT, "%NatGateway-Hours"), "NAT Gateway Hourly Charge"),
    (("like", UT, "%In-Bytes"), "NAT Gateway Data Transfer In"),
    (("like", UT, "%Out-Bytes"), "NAT Gateway Data Transfer Out"),
    (("like", UT, "%Regional-Bytes"), "NAT Gateway Data Transfer Same Region"),
]
NAT_GATEWAY_DEFAULT = ("col", UT)

# ---- NAT gateway usage category of the daily NAT model ------------------------------------------
NAT_USAGE = [
    (("like", UT, "%NatGateway-Bytes"), "NAT Gateway Data Processing"),
    (("like", UT, "%NatGateway-Hours"), "NAT Gateway Hourly Usage"),
    (("like", UT, "%In-Bytes"), "NAT Gateway Data Transfer In"),
    (("like", UT, "%Out-Bytes"), "NAT Gateway Data Transfer Out"),
    (("like", UT, "%Regional-Bytes"), "NAT Gateway Data Transfer Same Region"),
]
NAT_USAGE_DEFAULT = "Other"

# ---- per-service network rule sets ---------------------------------------------------------------
from costlake.functions.classify import like_rules  # noqa: E402
from costlake.functions.classify.families import A, L, N  # noqa: E402

API_GATEWAY = like_rules(UT, [
    ("%Request%", "API Gateway [Requests]"), ("%Message%", "API Gateway [Messages]"),
    ("%WebSocket%", "API Gateway [WebSocket]"), ("%Cache%", "API Gateway [Cache]"),
    ("%DataTransfer%", "API Gateway [Data Transfer]"), ("%Domain%", "API Gateway [Custom Domains]"),
])
CLOUDFRONT = like_rules(UT, [
    ("%Requests%", "CloudFront [Requests]"), ("%Out-Bytes%", "CloudFront [Data Transfer]"),
    ("%DataTransfer%", "CloudFront [Data Transfer]"), ("%OriginShield%", "CloudFront [Origin Shield]"),
    ("%Origin%", "CloudFront [Origin]"), ("%Lambda%", "CloudFront [Edge Compute]"),
    ("%Function%", "CloudFront [Edge Compute]"), ("%Encrypt%", "CloudFront [Encryption]"),
    ("%Log%", "CloudFront [Logs]"), ("%Invalidation%", "CloudFront [Invalidation]"), ("%SSL%", "CloudFront [SSL]"),
    ("%DedicatedIP%", "CloudFront [SSL]"),
])
ELB = like_rules(UT, [
    ("%LoadBalancerUsage%", "ELB [Hourly]"), ("%LCUUsage%", "ELB [Capacity Units]"),
    ("%NLCUUsage%", "ELB [Capacity Units]"), ("%GLCUUsage%", "ELB [Capacity Units]"),
    ("%DataProcessing-Bytes%", "ELB [Data Processing]"), ("%Out-Bytes%", "ELB [Data Transfer]"),
    ("%In-Bytes%", "ELB [Data Transfer]"), ("%Regional-Bytes%", "ELB [Data Transfer]"),
    ("%Address%", "ELB [IP Address]"),
])
ROUTE53 = like_rules(UT, [
    ("%Queries%", "Route 53 [Queries]"), ("%HostedZone%", "Route 53 [Hosted Zones]"),
    ("%HealthCheck%", "Route 53 [Health Checks]"), ("%Resolver%", "Route 53 [Resolver]"),
    ("%TrafficFlow%", "Route 53 [Traffic Flow]"), ("%Domain%", "Route 53 [Domains]"),
    ("%DNSSEC%", "Route 53 [DNSSEC]"), ("%ARC%", "Route 53 [ARC]"),
])
# Fixed values
TRANSFER = [
    (A(L("%SFTP%"), L("%EndpointHour%")), "Transfer SFTP Endpoint Hours [Network]"),
    (A(L("%SFTP%"), L("%Upload%")), "Transfer SFTP Upload [Network]"),
    (A(L("%SFTP%"), L("%Download%")), "Transfer SFTP Download [Network]"),
    (A(L("%FTPS%"), L("%EndpointHour%")), "Transfer FTPS Endpoint Hours [Network]"),
    (A(L("%FTPS%"), L("%Upload%")), "Transfer FTPS Upload [Network]"),
    (A(L("%FTPS%"), L("%Download%")), "Transfer FTPS Download [Network]"),
    (A(L("%FTP%"), L("%EndpointHour%"), N("%SFTP%"), N("%FTPS%")), "Transfer FTP Endpoint Hours [Network]"),
    (A(L("%FTP%"), L("%Upload%"), N("%SFTP%"), N("%FTPS%")), "Transfer FTP Upload [Network]"),
    (A(L("%FTP%"), L("%Download%"), N("%SFTP%"), N("%FTPS%")), "Transfer FTP Download [Network]"),
    (A(L("%AS2%"), L("%EndpointHour%")), "Transfer AS2 Endpoint Hours [Network]"),
    (A(L("%AS2%"), L("%Message%")), "Transfer AS2 Messages [Network]"),
    (L("%DataTransfer%"), "Transfer Data Transfer [Network]"),
]

_SC = "service_code"


def _sc(code):
    return ("eq", _SC, code)


NETWORK = [
    (A(_sc("AmazonEC2"), L("%NatGateway-Bytes%")), "Network NAT Gateway [Data Processing]"),
    (A(_sc("AmazonEC2"), L("%NatGateway-Hours%")), "Network NAT Gateway [Hourly]"),
    (("eq", OP, "VPCPeering-In"), "Network VPC Peering [Inbound]"),
    (("eq", OP, "VPCPeering-Out"), "Network VPC Peering [Outbound]"),
    (A(("eq", OP, "CreateVpnConnection"), ("or", L("%DataTransfer-Out-Bytes%"), L("%AWS-Out-Bytes%"))),
     "Network VPN [Data Transfer]"),
    (("eq", OP, "CreateVpnConnection"), "Network VPN [Connection]"),
    (("eq", OP, "VpcEndpoint"), "Network VPC Endpoint [Usage]"),
    (L("%TransitGateway-Bytes%"), "Network Transit Gateway [Data Processing]"),
    (L("%TransitGateway-Hours%"), "Network Transit Gateway [Hourly]"),
    (L("%TransitGatewayVPNAttachment%"), "Network Transit Gateway [VPN Attachment]"),
    (L("%TransitGatewayPeeringAttachment%"), "Network Transit Gateway [Peering Attachment]"),
    (A(_sc("AWSDirectConnect"), L("%DataXfer%")), "Network Direct Connect [Data Transfer]"),
    (A(_sc("AWSDirectConnect"), L("%Port%")), "Network Direct Connect [Port Hours]"),
    (_sc("AWSDirectConnect"), "Network Direct Connect [Other]"),
    (A(_sc("AmazonCloudFront"), L("%Out-Bytes%")), "Network CloudFront [Data Transfer Out]"),
    (A(_sc("AmazonCloudFront"), L("%Requests%")), "Network CloudFront [Requests]"),
    (_sc("AmazonCloudFront"), "Network CloudFront [Other]"),
    (A(_sc("AmazonEC2"), L("%Nat%")), "Network NAT Gateway [Other]"),
    (A(_sc("AmazonVPC"), L("%PrivateLink%")), "Network VPC [PrivateLink]"),
    (_sc("AmazonVPC"), "Network VPC [Other]"),
    (_sc("AWSGlobalAccelerator"), "Network Global Accelerator [Usage]"),
    (_sc("AWSNetworkFirewall"), "Network Firewall [Usage]"),
] + like_rules(UT, [
    ("%AWS-Out-Bytes%", "Network Data Transfer [Inter-Region]"),
    ("%S3RTC%", "Network Data Transfer [S3 Replication]"),
    ("%DataTransfer-Regional-Bytes%", "Network Data Transfer [Inter-AZ]"),
    ("%Regional-Bytes%", "Network Data Transfer [Same Region]"),
    ("%DataTransfer-Out-Bytes%", "Network Data Transfer [Internet Out]"),
    ("%DataTransfer-Out-ABytes%", "Network Data Transfer [Accelerated Out]"),
    ("%DataTransfer-In-Bytes%", "Network Data Transfer [Internet In]"),
    ("%In-Bytes%", "Network Data Transfer [In]"),
    ("%Out-Bytes%", "Network Data Transfer [Out]"),
])
NETWORK_DEFAULT = "Network [Other]"
