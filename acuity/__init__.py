"""Hourly organ-failure scoring for intensive-care records on Spark."""
