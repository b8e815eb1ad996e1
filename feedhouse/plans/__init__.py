"""Ready-made analytics and the load job."""
