"""Readers of exports, ground truth, chats and meshes, and writers of results."""
