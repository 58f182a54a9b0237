"""The batch jobs: read, transform with the operators, write."""
