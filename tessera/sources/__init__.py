from tessera.sources.fixtures import view, with_views
from tessera.sources.tables import BASE_TABLES, table

__all__ = ["BASE_TABLES", "table", "view", "with_views"]
