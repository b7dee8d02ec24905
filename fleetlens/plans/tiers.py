"""Reporter version tiers: what a host of a given version can be asked for.

Some report names carry the name of the management product. They are not written
here; ``product`` is the prefix they share, e.g. ``<product>_imageio``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.versions import version_key


@dataclass(frozen=True)
class Tier:
    """One tier of host reporters; it holds from ``minimum`` on."""

    name: int
    minimum: tuple[int, int]
    command: str
    reports: tuple[str, ...]
    options: tuple[str, ...] = ("--batch",)
    leading: tuple[str, ...] = ()
    takes_base: bool = True
    takes_chain: bool = False
    takes_logs: bool = True
    takes_all_logs: bool = True


# The reports every host tier but the lowest asks for.
BASE_REPORTS = (
    "libvirt", "vdsm", "networking", "hardware", "process", "filesys",
    "devicemapper", "selinux", "kernel", "memory", "rpm",
)

# The only reports of the lowest tier.
LOWEST_REPORTS = ("vdsm", "general", "networking", "hardware", "process", "filesys")

# The reports tier 30 adds, each named once.
TIER_30_REPORTS = (
    "processor", "pci", "md", "block", "general", "scsi", "multipath",
    "systemd", "sanlock", "lvm2", "chrony", "ipmitool",
)

CHAIN_REPORT = "vdsm.dump-volume-chains"  # fixed value
GLUSTER_REPORT = "gluster"  # fixed value
LOGS_REPORT = "logs"  # fixed value
LOGS_FROM_MIB = 100  # fixed value: the smallest size cap that keeps the logs report


def host_tiers(product: str) -> tuple[Tier, ...]:
    """The nine tiers, lowest first."""
    # What each tier adds to the one below it; 36 drops one report as well.
    adds = {
        32: ("firewalld", "openvswitch", f"{product}_hosted_engine"),
        33: ("virsh",),
        34: ("collectd",),
        35: (f"{product}_imageio",),
        36: ("date", "host", f"{product}_node", "ovn_host"),
    }
    drops = {36: "general"}

    def upto(last: int) -> tuple[str, ...]:
        added = sum((names for tier, names in adds.items() if tier <= last), TIER_30_REPORTS)
        gone = {name for tier, name in drops.items() if tier <= last}
        return tuple(name for name in added if name not in gone)

    tier_32, tier_33, tier_34, tier_35, split = (upto(tier) for tier in adds)
    return (
        Tier(
            17, (1, 7), "sosreport", LOWEST_REPORTS, ("--no-progressbar", "-k general.all_logs=True"),
            takes_base=False, takes_logs=False, takes_all_logs=False,
        ),
        Tier(
            22, (2, 2), "sosreport", (), ("--batch", "-k general.all_logs=True"),
            leading=("general",), takes_logs=False, takes_all_logs=False,
        ),
        Tier(
            30, (3, 0), "sosreport", TIER_30_REPORTS, ("--batch", "-k logs.all_logs=True"),
            takes_all_logs=False,
        ),
        Tier(32, (3, 2), "sosreport", tier_32),
        Tier(33, (3, 3), "sosreport", tier_33),
        Tier(34, (3, 4), "sosreport", tier_34),
        Tier(35, (3, 5), "sosreport", tier_35, takes_chain=True),
        Tier(36, (3, 6), "sosreport", split, takes_chain=True),
        Tier(40, (4, 0), "sos report", split, takes_chain=True),
    )


def tier_of(version: Column, tiers: Sequence[Tier]) -> Column:
    """The highest tier whose minimum the version reaches; null below the lowest.

    The tiers are a short fixed list, so the as-of lookup is a CASE expression:
    no join and no shuffle, however many hosts there are.
    """
    key = version_key(version)
    found = F.lit(None).cast("int")
    for tier in sorted(tiers, key=lambda tier: tier.minimum):
        major, minor = tier.minimum
        found = F.when(key >= F.struct(F.lit(major), F.lit(minor)), tier.name).otherwise(found)
    return found


def by_tier(column: str, tiers: Sequence[Tier], value: Callable[[Tier], str | bool]) -> Column:
    """A fixed value per tier, looked up by the tier number in a column."""

    found = F.lit(None)
    for tier in reversed(tiers):
        found = F.when(F.col(column) == tier.name, F.lit(value(tier))).otherwise(found)
    return found
