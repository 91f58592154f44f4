"""End-to-end workloads composed from the operators, and the query registry."""
