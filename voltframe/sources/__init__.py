"""Sources and sinks: landed API responses, typed files, the event catalog."""

from voltframe.sources.catalog import event_catalog, read_catalog  # noqa: F401
from voltframe.sources.files import read_csv_checked, read_csv_typed, write_if_not_empty, write_table  # noqa: F401
from voltframe.sources.landing import (  # noqa: F401
    nan_to_null,
    parse_demand_pages,
    parse_emissions_responses,
    process_demand,
    read_demand_pages,
    read_emissions_landing,
    rename_if_present,
)
