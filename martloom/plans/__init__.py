"""Named models: staging, marts, reports and the daily build."""
