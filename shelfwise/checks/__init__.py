"""Reference SQL used to check the Spark queries."""
