"""End-to-end flows that chain the operators."""
