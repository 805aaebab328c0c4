"""Compute rule sets. Patterns, operation codes, labels and normalisation factors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from costlake.functions.classify import like_rules

UT, OP = "usage_type", "operation"

LAMBDA = like_rules(UT, [
    ("%Lambda-GB-Second%", "Lambda GB x Seconds"),
    ("%Request%", "Lambda Requests"),
    ("%Lambda-Provisioned-GB-Second%", "Lambda Provisioned GB x Seconds"),
    ("%Lambda-Provisioned-Concurrency%", "Lambda Provisioned Concurrency"),
    ("%Lambda-Edge-GB-Second%", "Lambda EDGE GB x Seconds"),
    ("%Lambda-Edge-Request%", "Lambda EDGE Requests"),
    ("%Lambda-Storage-GB-Second%", "Lambda Ephemeral Storage GB x Seconds"),
    ("%Lambda-Streaming-Response-Processed-Bytes%", "Lambda Streaming Response Processed Bytes"),
    ("%Lambda-SnapStart-Cached-GB-S%", "Lambda SnapStart Cached GB x Seconds"),
    ("%Lambda-SnapStart-Restored-GB%", "Lambda SnapStart Restored GB"),
    ("%In-Bytes%", "Lambda Data Transfer (In)"),
    ("%Out-Bytes%", "Lambda Data Transfer (Out)"),
    ("%Regional-Bytes%", "Lambda Data Transfer (Regional)"),
])
LAMBDA_DEFAULT = "Lambda [Other]"

# operation code (the part after ':') -> operating system
OS_CODES = [
    ("0002", "Windows"),
    ("0004", "Linux with SQL Server Standard"),
    ("0006", "Windows with SQL Server Standard"),
    ("000g", "SUSE Linux"),
    ("0010", "Red Hat Enterprise Linux"),
    ("0014", "Red Hat Enterprise Linux with SQL Server Standard"),
    ("0100", "SQL Server Enterprise"),
    ("0102", "Windows with SQL Server Enterprise"),
    ("0110", "Red Hat Enterprise Linux with SQL Server Enterprise"),
    ("0200", "SQL Server Web"),
    ("0202", "Windows with SQL Server Web"),
    ("0210", "Red Hat Enterprise Linux with SQL Server Web"),
    ("0800", "Windows BYOL"),
    ("0g00", "Ubuntu Pro"),
    ("00g0", "Red Hat BYOL Linux"),
    ("1010", "Red Hat Enterprise Linux with HA"),
    ("1014", "Red Hat Enterprise Linux with HA and SQL Server Standard"),
    ("1110", "Red Hat Enterprise Linux with HA and SQL Server Enterprise"),
]
OPERATING_SYSTEM = ([(("eq", ("split_part", OP, ":", 2), code), label) for code, label in OS_CODES]
                    + [(("like", ("split_part", OP, ":", 2), "SV%"), "Linux/UNIX"),
                       (("eq", OP, "RunInstances"), "Linux/UNIX")])
OPERATING_SYSTEM_DEFAULT = ("col", "operating_system")

# normalisation units of fixed sizes
SIZE_FACTORS = [("xlarge", 8), ("large", 4), ("medium", 2), ("small", 1), ("micro", 0.5), ("nano", 0.25)]
# family -> units when the size is not one of the above (metal and other sizes); (family, metal, other)
FAMILY_FACTORS = [
    ("a1", None, 32), ("c5", 192, 144), ("c5d", 192, 144), ("c5n", None, 144), ("c6a", None, 384),
    ("c6g", None, 128), ("c6gd", None, 128), ("c6i", None, 256), ("c6id", None, 256), ("c6in", None, 256),
    ("c7a", None, 384), ("c7g", None, 128), ("c7i", 384, 192), ("g4dn", None, 192), ("g5g", None, 128),
    ("i3", None, 144), ("i3en", None, 192), ("i4i", None, 256), ("m5", None, 192), ("m5d", None, 192),
    ("m5dn", None, 192), ("m5n", None, 192), ("m5zn", None, 96), ("m6a", None, 384), ("m6g", None, 128),
    ("m6gd", None, 128), ("m6i", None, 256), ("m6id", None, 256), ("m6idn", None, 256), ("m6in", None, 256),
    ("m7a", None, 384), ("m7g", None, 128), ("m7i", 384, 192), ("mac1", None, 24), ("mac2-m2", None, 24),
    ("mac2", None, 24), ("r5", None, 192), ("r5b", None, 192), ("r5d", None, 192), ("r5dn", None, 192),
    ("r5n", None, 192), ("r6a", None, 384), ("r6g", None, 128), ("r6gd", None, 128), ("r6i", None, 256),
    ("r6id", None, 256), ("r6idn", None, 256), ("r6in", None, 256), ("r7a", None, 384), ("r7g", None, 128),
    ("r7i", 384, 192), ("r7iz", 256, 128), ("u-12tb1", None, 896), ("u-18tb1", None, 896),
    ("u-24tb1", None, 896), ("u-6tb1", None, 896), ("u-9tb1", None, 896), ("x2gd", None, 128),
    ("x2idn", None, 256), ("x2iedn", None, 256), ("x2iezn", None, 96), ("z1d", None, 96),
]
NXLARGE = r"^[0-9]+xlarge$"


def instance_normalization_factor(size: str = "instance_size", family: str = "instance_type_family") -> Column:
    """Normalisation units: N x 8 for 'Nxlarge', fixed sizes, then family defaults, else 0 (DECIMAL)."""
    s, f = F.col(size), F.col(family)
    out = F.when(s.rlike(NXLARGE), F.regexp_replace(s, "xlarge", "").try_cast("int") * 8)
    for name, units in SIZE_FACTORS:
        out = out.when(s == name, F.lit(units))
    for fam, metal, other in FAMILY_FACTORS:
        v = F.lit(other) if metal is None else F.when(s == "metal", F.lit(metal)).otherwise(F.lit(other))
        out = out.when(f == fam, v)
    return F.coalesce(out.otherwise(F.lit(0)).cast("decimal(18,6)"), F.lit(0).cast("decimal(18,6)"))


def instance_normalization_factor_sql(size: str = "instance_size", family: str = "instance_type_family") -> str:
    parts = [f"WHEN regexp_matches({size}, '{NXLARGE}') THEN TRY_CAST(replace({size}, 'xlarge', '') AS INTEGER) * 8"]
    parts += [f"WHEN {size} = '{n}' THEN {u}" for n, u in SIZE_FACTORS]
    for fam, metal, other in FAMILY_FACTORS:
        v = str(other) if metal is None else f"CASE WHEN {size} = 'metal' THEN {metal} ELSE {other} END"
        parts.append(f"WHEN {family} = '{fam}' THEN {v}")
    return f"coalesce(CAST(CASE {' '.join(parts)} ELSE 0 END AS DECIMAL(18,6)), 0)"


# Fixed value: Graviton instance families in a usage type (e.g. 'BoxUsage:m6g.large')
GRAVITON_PATTERN = r".?[a-z]([1-9]|[1-9][0-9]).?.?[g][a-zA-Z]?\."

# ---- EC2 usage categories (labels built from family and purchase option; EBS rows delegate) -------
from costlake.functions.classify.families import A as _A, L as _L, N as _N  # noqa: E402
from costlake.functions.classify.storage import EBS as _EBS, EBS_DEFAULT as _EBS_DEFAULT  # noqa: E402


def _fam(suffix: str):
    return ("concat", "EC2 ", ("col", "instance_type_family"), " ", ("col", "purchase_option"), f" {suffix}")


EC2 = [
    (_A(_L("%BoxUsage%"), _N("%HostBoxUsage%")), _fam("[Compute]")),
    (_L("%SpotUsage%"), _fam("[Compute]")),
    (_L("%HostBoxUsage%"), _fam("Dedicated Host Instance [Compute]")),
    (_A(_L("%HostUsage%"), _N("%HostBoxUsage%")), "EC2 Dedicated Host Provisioned [Compute]"),
    (_L("%ReservedHostUsage%"), "EC2 Reserved Dedicated Host [Compute]"),
    (_L("%DedicatedUsage%"), _fam("Dedicated Instance [Compute]")),
    (_L("%EBSOptimized%"), _fam("EBS Optimization [Compute]")),
    (_A(_L("%Reservation%"), _N("%CapacityReservation%")), _fam("Capacity Reservation [Compute]")),
    (_L("%UnusedBox%"), _fam("Unused Capacity Reservation [Compute]")),
    (_L("%DedicatedRes%"), _fam("Dedicated Capacity Reservation [Compute]")),
    (_L("%UnusedDed%"), _fam("Unused Dedicated Capacity Reservation [Compute]")),
    (_L("%HeavyUsage%"), _fam("Reserved (Legacy) [Compute]")),
    (_L("%ReservedInstancesUsage%"), _fam("Reserved (Legacy) [Compute]")),
] + like_rules(UT, [
    ("%CPUCredits%", "EC2 CPU Credits [Compute]"),
    ("%ElasticIP%", "EC2 Elastic IP [Network]"),
    ("%AdditionalAddress%", "EC2 Elastic IP [Network]"),
    ("%DataTransfer-Out%", "EC2 Data Transfer Out [Network]"),
    ("%DataTransfer-In%", "EC2 Data Transfer In [Network]"),
    ("%DataTransfer-Regional%", "EC2 Data Transfer Regional [Network]"),
    ("%AWS-Out-Bytes%", "EC2 Data Transfer Out [Network]"),
    ("%AWS-In-Bytes%", "EC2 Data Transfer In [Network]"),
    ("%DataXfer%", "EC2 Data Transfer [Network]"),
    ("%LoadBalancer%", "EC2 Load Balancer [Network]"),
    ("%ELB%", "EC2 Load Balancer [Network]"),
    ("%NatGateway%", "EC2 NAT Gateway [Network]"),
    ("%VPN%", "EC2 VPN [Network]"),
    ("%VpnConnection%", "EC2 VPN [Network]"),
]) + [(_L("%EBS:%"), ("rules", _EBS, _EBS_DEFAULT))] + like_rules(UT, [
    ("%InstanceStore%", "EC2 Instance Storage [Storage]"),
    ("%CloudWatchMonitoring%", "EC2 CloudWatch Monitoring [Management]"),
    ("%InstanceConnect%", "EC2 Instance Connect [Management]"),
    ("%ImageBuilder%", "EC2 Image Builder [Management]"),
    ("%SystemsManager%", "EC2 Systems Manager [Management]"),
    ("%CapacityReservation%", "EC2 Capacity Reservation [Compute]"),
    ("%SavingsPlans%", "EC2 Savings Plans [Compute]"),
])
EC2_DEFAULT = "EC2 [Other]"
