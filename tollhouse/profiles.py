"""What differs between the metered services; every report is written once and takes a profile."""

from __future__ import annotations

from dataclasses import dataclass, field

# Offerings counted as customers of service A.
CUSTOMER_OFFERINGS = ("607996", "615324", "729920", "615325", "607997", "631467")
# Offerings whose subscriptions keep an account in the directory.
SUBSCRIPTION_OFFERINGS = ("607996", "607997", "615324", "615325", "729920")
# Offerings that include a free allowance.
FREE_OFFERING = "607996"
FREE_OFFERINGS = ("607996", "615324")


@dataclass(frozen=True)
class ServiceProfile:
    """Tokens and rules of one metered service.

    ``lab_pattern`` and ``reseller_pattern`` are case-insensitive regular expressions over company
    names; they belong to the caller's customers, so there is no default: a report that needs one that is not set says so.
    """

    name: str
    product_code: str
    instance_token: str
    # metric suffix -> regular expression over usage_type
    categories: dict[str, str] = field(hash=False)
    # metric suffix -> operation code
    generations: dict[str, str] = field(hash=False)
    # only instance rows reach the weekly metering extract
    metering_instances_only: bool
    # the weekly metering extract is also split by operation
    metering_by_operation: bool
    # resources are counted per (account, resource) rather than per resource
    domains_per_account: bool
    # instance type assumed where compute usage names none
    default_compute_type: str
    # text removed from monitoring usage types
    monitor_prefix: str
    # block storage, half-billed services, bandwidth and sales enter the cost
    full_cost_model: bool
    lab_pattern: str | None = None
    reseller_pattern: str | None = None

    def required(self, name: str) -> str:
        value = getattr(self, name)
        if not value:
            raise ValueError(f"set {name} of service {self.name}, with dataclasses.replace")
        return value


# Usage-type tokens of service A.
SERVICE_A = ServiceProfile(
    name="A",
    product_code="AmazonES",
    instance_token="ESInstance",
    categories={"instance": "ESInstance", "transfer": "-Out", "storage": "Storage|PIOPS"},
    generations={},
    metering_instances_only=True,
    metering_by_operation=False,
    domains_per_account=False,
    default_compute_type="",
    monitor_prefix="CW:",
    full_cost_model=True,
)

# Usage-type tokens and operation codes of service B.
SERVICE_B = ServiceProfile(
    name="B",
    product_code="AmazonCloudSearch",
    instance_token="SearchInstance",
    categories={
        "upload": "DocumentBatchUpload",
        "index": "IndexDocuments",
        "instance": "SearchInstance",
        "transfer": "Out-Bytes",
    },
    generations={"2011": "CSDomain:001", "2013": "CSDomain:002"},
    metering_instances_only=False,
    metering_by_operation=True,
    domains_per_account=True,
    default_compute_type="m1.small",
    monitor_prefix="",
    full_cost_model=False,
)
