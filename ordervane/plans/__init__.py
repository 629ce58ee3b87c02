"""The layered models: staging, intermediate, warehouse, marts, and their runs."""
