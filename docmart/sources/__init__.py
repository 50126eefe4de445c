from .tables import Catalog, load_catalog, load_test_catalog, read_table

__all__ = ["Catalog", "load_catalog", "load_test_catalog", "read_table"]
