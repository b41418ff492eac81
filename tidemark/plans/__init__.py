"""Jobs that read, transform and publish the layers."""
