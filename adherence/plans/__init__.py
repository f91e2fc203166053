"""Composite plans: bindings of the logical tables to given data, pipelines
(load_static, trip_delays, ...) and the catalogue of registered queries."""
