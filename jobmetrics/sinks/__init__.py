"""Writers: fact lake, warehouse, event topic, table creation."""
