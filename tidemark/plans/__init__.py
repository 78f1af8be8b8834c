"""Query plans over the persisted METRICS / ALERTS tables: serving and dashboard queries."""
