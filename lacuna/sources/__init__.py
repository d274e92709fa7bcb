from lacuna.sources.tables import TABLES, load, register_views, document_features

__all__ = ["TABLES", "load", "register_views", "document_features"]
