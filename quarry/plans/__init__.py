"""Query catalog (Spark side), SQL twins (oracle side) and input views."""
