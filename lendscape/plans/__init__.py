"""The credit-risk layers assembled from the operators."""
